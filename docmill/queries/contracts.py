"""What a contract's mapping types do by themselves: picks among parties, rows from columns, required and conditional values."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import shred as s
from ..operators import sinks
from ..plans.contract import Contract, Mapping, checked_table, parse, table
from ..plans.dispatch import record_rows
from ..sources.staging import shared_path, staged
from . import shredding as x
from .base import query

ADDRESS = f"{x.CONTACT}/contact_address"
AT = {"/Envelope/Request": "d.Request", x.APP: "d.Request.CustData.application", x.CONTACT: "d.Request.CustData.application.contact"}

CONTRACT = Contract(
    x.ROOT, x.APP, [x.CONTACT, ADDRESS],
    [
        Mapping(x.CONTACT, "con_id", "picked", "primary_id", "bigint", mapping_type=["last_valid_pr_contact"]),
        Mapping(x.CONTACT, "first_name", "picked", "secondary_name", "string", 50, ["last_valid_sec_contact"]),
        Mapping(x.CONTACT, "ac_role", "picked", "authorized_role", "smallint", None, ["authu_contact", "enum"], enum_name="role_enum"),
        Mapping(ADDRESS, "supp", "picked", "primary_supp", "bigint", None, ["last_valid_pr_contact"]),
        Mapping(ADDRESS, "supp", "current", "supp", "bigint", None, ["curr_address_only"]),
        Mapping(x.APP, "score_a", "scores", "", "int", None, ["add_score(A_SCORE)"]),
        Mapping(x.APP, "score_b", "scores", "", "int", None, ["add_score(B_SCORE)"]),
        Mapping(x.APP, "signature_ind", "indicators", "", "string", None, ["add_indicator(signed)"]),
        Mapping(x.CONTACT, "first_name", "history", "", "string", None, ["last_valid_pr_contact", "add_history"]),
        Mapping(x.APP, "segment", "history", "", "string", None, ["add_history"]),
        Mapping(x.APP, "segment", "reports", "", "string", None, ["add_report_lookup(KEY_7)"]),
        Mapping(x.APP, "score_b", "reports", "", "string", None, ["add_report_lookup"]),
        Mapping(x.APP, "segment", "exceptions", "notes", "string", None, ["policy_exceptions()"]),
        Mapping(x.APP, "score_a", "exceptions", "reason_code", "string", None, ["policy_exceptions(630)"]),
        Mapping(x.APP, "score_b", "exceptions", "reason_code", "string", None, ["policy_exceptions(631)"]),
        Mapping(x.APP, "segment", "warranties", "company", "string", 20, ["warranty_field(601)"]),
        Mapping(x.APP, "signature_ind", "warranties", "lien_flag", "bit", None, ["char_to_bit", "warranty_field(601)"]),
        Mapping(x.APP, "score_b", "warranties", "company", "string", 20, ["warranty_field(602)"]),
        Mapping(x.APP, "score_b", "collateral", "year", "int", None, ["numbers_only", "add_collateral(1)"]),
        Mapping(x.APP, "signature_ind", "collateral", "used_flag", "bit", None, ["char_to_bit", "add_collateral(1)"]),
        Mapping(x.APP, "nation", "collateral", "wholesale_value", "int", None, ["add_collateral(2)"]),
        Mapping(x.APP, "segment", "required", "segment", "string", 20, nullable=False),
        Mapping(x.APP, "score_b", "required", "score", "int", nullable=False),
        Mapping(x.APP, "never", "required", "source", "string", 10, default_value="mail", nullable=False),
        Mapping(x.APP, "segment", "conditional", "segment", "string", 20),
        Mapping(x.APP, "score_b", "conditional", "score", "int"),
        Mapping(x.APP, "never", "conditional", "born", "string", 10, default_value="1900-01-01", exclude_default_when_record_empty=True),
    ],
    {x.CONTACT: {"con_id": True, "ac_role": ["A", "N", "R"]}, ADDRESS: {"type": ["CURR", "PREV"]}},
    x.CONTRACT.enums, x.CONTRACT.bits,
)


def rows(t, name):
    return parse(x.documents(t), CONTRACT, name)


def last(role: str, value: str) -> str:
    return f"(SELECT {value} FROM contacts c WHERE c.app_id = o_orderkey AND c.role = '{role}' ORDER BY c.pos DESC LIMIT 1)"


NAME, SUPP = "concat('P&', CAST(con_id AS STRING))", "CASE WHEN line = 'O' THEN supp ELSE 0 END"


@query(
    "contract_picks",
    f"SELECT o_orderkey AS doc_id, {last('A', 'con_id')} AS primary_id, {last('N', NAME)} AS secondary_name, CASE WHEN "
    f"o_orderkey IN (SELECT app_id FROM contacts WHERE role = 'N') THEN 11 END AS authorized_role, {last('A', SUPP)} AS "
    "primary_supp FROM orders",
)
def contract_picks(t):
    """A row for each document; nothing is shuffled, as parties are an array of the document."""
    return table(rows(t, "picked"), CONTRACT, "picked", AT, ["doc_id"])


@query("contract_current_address", "SELECT app_id AS doc_id, pos, CASE WHEN line = 'O' THEN supp END AS supp FROM contacts")
def contract_current_address(t):
    parties = s.explode_path(rows(t, "current"), AT[x.CONTACT], "contact").withColumnRenamed("contact_pos", "pos")
    return table(parties, CONTRACT, "current", {x.CONTACT: "contact"}, ["doc_id", "pos"])


SCORED = "CASE WHEN id % 3 <> 1 THEN CAST(id % 850 AS INTEGER) END"
NUMBER = "try_cast(trim(num) AS DECIMAL(28,6))"


@query(
    "contract_scores",
    f"SELECT id AS doc_id, 'A_SCORE' AS score_identifier, CAST(round({NUMBER}, 0) AS INTEGER) AS score FROM raw WHERE {NUMBER} "
    f"IS NOT NULL UNION ALL SELECT id, 'B_SCORE', {SCORED} FROM raw WHERE id % 3 <> 1",
)
def contract_scores(t):
    return record_rows(rows(t, "scores"), CONTRACT, "scores", AT)


@query("contract_indicators", "SELECT id AS doc_id, 'signed' AS indicator, '1' AS value FROM raw WHERE lower(trim(flag)) IN ('y', 'yes', 'true', 't', '1')")
def contract_indicators(t):
    return record_rows(rows(t, "indicators"), CONTRACT, "indicators", AT)


@query(
    "contract_history",
    f"SELECT * FROM (SELECT o_orderkey AS doc_id, '[first_name]' AS name, '[contact]' AS source, {last('A', NAME)} AS value "
    "FROM orders) h WHERE value IS NOT NULL UNION ALL SELECT id, '[segment]', '[application]', c_mktsegment FROM raw JOIN "
    "customer ON cust = c_custkey",
)
def contract_history(t):
    return record_rows(rows(t, "history"), CONTRACT, "history", AT)


@query(
    "contract_reports",
    "SELECT id AS doc_id, 'segment' AS name, c_mktsegment AS value, 'KEY_7' AS source_report_key FROM raw JOIN customer "
    f"ON cust = c_custkey UNION ALL SELECT id, 'score_b', CAST({SCORED} AS STRING), NULL FROM raw WHERE id % 3 <> 1",
)
def contract_reports(t):
    return record_rows(rows(t, "reports"), CONTRACT, "reports", AT)


@query(
    "contract_exceptions",
    "SELECT id AS doc_id, 630 AS policy_exception_type_enum, trim(num) AS reason_code, c_mktsegment AS notes FROM raw "
    f"LEFT JOIN customer ON cust = c_custkey WHERE trim(num) <> '' UNION ALL SELECT id, 631, CAST({SCORED} AS STRING), "
    "c_mktsegment FROM raw LEFT JOIN customer ON cust = c_custkey WHERE id % 3 <> 1",
)
def contract_exceptions(t):
    return record_rows(rows(t, "exceptions"), CONTRACT, "exceptions", AT)


@query(
    "contract_warranties",
    "SELECT id AS doc_id, 601 AS warranty_type_enum, c_mktsegment AS company, CASE WHEN upper(trim(flag)) = 'Y' THEN 1 "
    f"ELSE 0 END AS lien_flag FROM raw JOIN customer ON cust = c_custkey UNION ALL SELECT id, 602, CAST({SCORED} AS STRING), "
    "0 FROM raw WHERE id % 3 <> 1",
)
def contract_warranties(t):
    return record_rows(rows(t, "warranties"), CONTRACT, "warranties", AT)


@query(
    "contract_collateral",
    f"SELECT id AS doc_id, 1 AS sort_order, {SCORED} AS year, CASE WHEN upper(trim(flag)) = 'Y' THEN 1 ELSE 0 END AS used_flag, "
    "CAST(NULL AS INTEGER) AS wholesale_value FROM raw WHERE id % 3 <> 1 UNION ALL SELECT id, 2, NULL, 0, CAST(c_nationkey "
    "AS INTEGER) FROM raw JOIN customer ON cust = c_custkey WHERE c_nationkey > 0",
)
def contract_collateral(t):
    """Slot 2 has an amount alone, which makes no row where it is 0."""
    return record_rows(rows(t, "collateral"), CONTRACT, "collateral", AT)


@query(
    "contract_required",
    f"SELECT id AS doc_id, c_mktsegment AS segment, {SCORED} AS score, 'mail' AS source FROM raw JOIN customer ON cust "
    "= c_custkey WHERE id % 3 <> 1",
)
def contract_required(t):
    """Documents without a score are in no row."""
    return checked_table(rows(t, "required"), CONTRACT, "required", AT, ["doc_id"])[0]


@query(
    "contract_rejects",
    "SELECT id AS doc_id, 'required' AS table_name, 'score' AS field, 'required' AS \"check\", 'critical' AS severity, 'no "
    "value and no default' AS message FROM raw WHERE id % 3 = 1 UNION ALL SELECT id, 'required', 'segment', 'required', "
    "'critical', 'no value and no default' FROM raw WHERE cust NOT IN (SELECT c_custkey FROM customer)",
)
def contract_rejects(t):
    return checked_table(rows(t, "required"), CONTRACT, "required", AT, ["doc_id"])[1]


@query(
    "contract_conditional",
    f"SELECT id AS doc_id, c_mktsegment AS segment, {SCORED} AS score, CASE WHEN c_mktsegment IS NOT NULL AND id % 3 <> "
    "1 THEN '1900-01-01' END AS born FROM raw LEFT JOIN customer ON cust = c_custkey",
)
def contract_conditional(t):
    """A default that a record with a single value of its own doesn't get."""
    return table(rows(t, "conditional"), CONTRACT, "conditional", AT, ["doc_id"])


@query(
    "contract_commit",
    f"SELECT id AS doc_id, c_mktsegment AS segment, {SCORED} AS score, 'mail' AS source, 'success' AS status, CAST(NULL AS STRING) AS failure_reason "
    "FROM raw JOIN customer ON cust = c_custkey WHERE id % 3 <> 1 UNION ALL SELECT id, NULL, NULL, NULL, 'failed', "
    "'mapping: required.score: no value and no default' FROM raw WHERE id % 3 = 1",
)
def contract_commit(t):
    """From documents to committed tables and their log: what lacks a required value fails as a whole, and is logged with the reason."""
    docs, path = staged(rows(t, "required"), "contract-rows"), shared_path(t.spark, "contract-commit")
    good, found = checked_table(docs, CONTRACT, "required", AT, ["doc_id"])
    failed = staged(sinks.failures(found), "contract-failures")
    log = sinks.log_outcomes(docs.select("doc_id").join(failed.select("doc_id"), "doc_id", "left_anti"), failed, "s1")
    sinks.commit_documents({"required": good}, failed, log, ["required"], path)
    outcome = t.spark.read.parquet(f"{path}/processing_log").select(F.col("app_id").alias("doc_id"), "status", "failure_reason")
    seen = sinks.visible(t.spark, path, "required")
    return outcome.join(seen, "doc_id", "left").select("doc_id", "segment", "score", "source", "status", "failure_reason")
