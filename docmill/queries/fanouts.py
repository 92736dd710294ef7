"""Whole contracts: every table of a contract from one parse, by its relationships; committed, resumed and streamed."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ..plans.contract import Contract
from ..plans.fanout import fan_out, load, outcomes
from ..operators import sinks
from ..sources.staging import dealt, shared_path
from ..streaming import incremental as inc
from . import shredding as x
from .base import query

ADDRESS = f"{x.CONTACT}/contact_address"


def mapping(path: str, attribute: str, table: str, column: str, data_type: str, **more) -> dict:
    return {"xml_path": path, "xml_attribute": attribute, "target_table": table, "target_column": column, "data_type": data_type, **more}


#: As a user writes it. The order of insertion names the deepest table first; relationships put parents before it.
CONTRACT = Contract.load(json.dumps({
    "xml_root_element": x.ROOT,
    "xml_application_path": x.APP,
    "repeated_paths": [x.CONTACT, ADDRESS],
    "table_insertion_order": ["contact_address", "app_base", "contact_base", "scores"],
    "relationships": [
        {"parent_table": "app_base", "child_table": "contact_base", "foreign_key_column": "app_id", "xml_parent_path": x.APP, "xml_child_path": x.CONTACT},
        {"parent_table": "app_base", "child_table": "contact_address", "foreign_key_column": "app_id", "xml_parent_path": x.APP, "xml_child_path": ADDRESS},
        {"parent_table": "contact_base", "child_table": "contact_address", "foreign_key_column": "con_id", "xml_parent_path": x.CONTACT, "xml_child_path": ADDRESS},
    ],
    "element_filtering": {"filter_rules": [
        {"xml_child_path": x.CONTACT, "required_attributes": {"con_id": True, "ac_role": ["A", "R"]}},
        {"xml_child_path": ADDRESS, "required_attributes": {"type": ["CURR", "PREV"]}},
    ]},
    "enum_mappings": {"status_enum": {"F": 1, "O": 2}, "role_enum": {"A": 10, "N": 11, "R": 12}},
    "mappings": [
        mapping("/Envelope/Request", "ID", "app_base", "app_id", "bigint", nullable=False),
        mapping("/Envelope/Request", "Status", "app_base", "app_status", "smallint", mapping_type="enum", default_value=7),
        mapping(x.APP, "segment", "app_base", "segment", "string", data_length=20),
        mapping(x.APP, "score_b", "app_base", "score", "int", nullable=False),
        mapping(x.CONTACT, "con_id", "contact_base", "con_id", "bigint"),
        mapping(x.CONTACT, "ac_role", "contact_base", "role_enum", "smallint", mapping_type="enum"),
        mapping(x.CONTACT, "first_name", "contact_base", "first_name", "string", data_length=50),
        mapping(ADDRESS, "type", "contact_address", "type", "string", data_length=4),
        mapping(ADDRESS, "supp", "contact_address", "supp", "bigint"),
        mapping(x.APP, "score_a", "scores", "", "int", mapping_type="add_score(A_SCORE)"),
        mapping(x.APP, "score_b", "scores", "", "int", mapping_type="add_score(B_SCORE)"),
    ],
}))

SCORE = "CASE WHEN id % 3 <> 1 THEN CAST(id % 850 AS INTEGER) END"
NUMBER = "try_cast(trim(num) AS DECIMAL(28,6))"
CONTACTS = "SELECT * FROM contacts WHERE role IN ('A', 'R') QUALIFY row_number() OVER (PARTITION BY app_id, con_id ORDER BY role = 'A' DESC, pos DESC) = 1"
ADDRESSES = (
    "SELECT app_id, con_id, CASE WHEN line = 'O' THEN 'CURR' ELSE 'PREV' END AS type, supp FROM contacts WHERE role IN ('A', 'R') "
    "UNION ALL SELECT app_id, con_id, 'PREV', 0 FROM contacts WHERE role IN ('A', 'R')"
)


def mapped(t):
    return fan_out(x.documents(t), CONTRACT)


@query("fanout_base", f"SELECT id AS doc_id, id AS app_id, CASE st WHEN 'F' THEN 1 WHEN 'O' THEN 2 END AS app_status, c_mktsegment AS segment, {SCORE} AS score FROM raw LEFT JOIN customer ON cust = c_custkey")
def fanout_base(t):
    """A row for each document. The status column finds its codes by its name; a value without a code is null, whatever the default."""
    return mapped(t).tables["app_base"]


@query("fanout_contacts", f"SELECT app_id AS doc_id, app_id, con_id, CASE role WHEN 'A' THEN 10 ELSE 12 END AS role_enum, concat('P&', CAST(con_id AS STRING)) AS first_name FROM ({CONTACTS}) c")
def fanout_contacts(t):
    """Children of documents, with their key; of contacts with one id the best role, then the last."""
    return mapped(t).tables["contact_base"]


@query("fanout_addresses", f"SELECT app_id AS doc_id, app_id, con_id, type, supp FROM ({ADDRESSES}) a")
def fanout_addresses(t):
    """Children of contacts, with the keys of both levels above."""
    return mapped(t).tables["contact_address"]


@query(
    "fanout_scores",
    f"SELECT id AS doc_id, 'A_SCORE' AS score_identifier, CAST(round({NUMBER}, 0) AS INTEGER) AS score FROM raw WHERE {NUMBER} IS NOT NULL "
    f"UNION ALL SELECT id, 'B_SCORE', {SCORE} FROM raw WHERE id % 3 <> 1",
)
def fanout_scores(t):
    return mapped(t).tables["scores"]


@query(
    "fanout_findings",
    "SELECT id AS doc_id, 'app_base' AS table_name, 'score' AS field, 'required' AS \"check\", 'critical' AS severity, 'no value and no default' AS message FROM raw WHERE id % 3 = 1 "
    "UNION ALL SELECT id, 'app_base', 'app_status', 'enum', 'warning', 'no code for the value' FROM raw WHERE st NOT IN ('F', 'O')",
)
def fanout_findings(t):
    return mapped(t).findings


@query("fanout_order", "SELECT 1 AS nth, 'app_base' AS name UNION ALL SELECT 2, 'contact_base' UNION ALL SELECT 3, 'contact_address' UNION ALL SELECT 4, 'scores'")
def fanout_order(t):
    """The tables in which rows are written: parents first, whatever the contract's list says. Each is counted from what was written."""
    path, tables = shared_path(t.spark, "fanout-order"), mapped(t).tables
    names = sinks.write_tables(tables, list(tables), path)
    counts = [t.spark.read.parquet(f"{path}/{n}").agg(F.count("*").alias("n")).select(F.lit(i).alias("nth"), F.lit(n).alias("name"), "n") for i, n in enumerate(names, 1)]
    return sinks.union_columns(*counts).filter("n > 0").drop("n")


def seen(t, path: str):
    """Outcome of each document, and how many contacts and addresses are seen of it."""
    log = outcomes(t.spark, path).select("app_id", "status", "failure_reason")
    counts = [sinks.visible(t.spark, path, n).groupBy(F.col("doc_id").alias("app_id")).agg(F.count("*").alias(c)) for n, c in (("contact_base", "contacts"), ("contact_address", "addresses"))]
    return log.join(dealt(counts[0]), "app_id", "left").join(dealt(counts[1]), "app_id", "left").fillna(0, ["contacts", "addresses"])


REASON = "'mapping: app_base.score: no value and no default'"
SEEN_SQL = (
    f"SELECT o_orderkey AS app_id, CASE WHEN o_orderkey % 3 = 1 THEN 'failed' ELSE 'success' END AS status, CASE WHEN o_orderkey % 3 = 1 THEN {REASON} END AS failure_reason, "
    f"CASE WHEN o_orderkey % 3 = 1 THEN 0 ELSE (SELECT count(*) FROM ({CONTACTS}) c WHERE c.app_id = o_orderkey) END AS contacts, "
    f"CASE WHEN o_orderkey % 3 = 1 THEN 0 ELSE (SELECT count(*) FROM ({ADDRESSES}) a WHERE a.app_id = o_orderkey) END AS addresses FROM orders"
)


@query("fanout_load", SEEN_SQL)
def fanout_load(t):
    """Two runs: the second one takes what the first one's log lacks. A failed document is seen in no table."""
    path, docs = shared_path(t.spark, "fanout-load"), x.documents(t)
    load(docs.filter("doc_id % 2 = 0"), CONTRACT, path, "s1")
    load(docs, CONTRACT, path, "s2")
    return seen(t, path)


@query("fanout_stream", SEEN_SQL)
def fanout_stream(t):
    """The same from a stream of files, in which each document is sent twice; each is committed and logged once."""
    source, path, docs = shared_path(t.spark, "fanout-in"), shared_path(t.spark, "fanout-out"), x.documents(t)
    docs.write.option("compression", "zstd").parquet(source)
    sent = len(t.spark.read.schema(docs.schema).parquet(source).inputFiles())
    docs.write.mode("append").option("compression", "zstd").parquet(source)
    inc.stream_load(t.spark, source, docs.schema, CONTRACT, path, shared_path(t.spark, "fanout-log"), "s1", max(1, sent))
    return seen(t, path)
