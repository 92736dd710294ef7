"""Validation of documents and of mapped rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as q
from ..operators import shred as s
from . import shredding as x
from .base import query

SEVERE = (
    "SELECT app_id AS doc_id, 'codes' AS table_name, '{f}' AS field, 'required' AS \"check\", 'error' AS severity, 'missing' "
    "AS message FROM codes WHERE {f} IS NULL"
)


def checked(t):
    docs = x.dirty(t).withColumn("xml", s.clean_xml(F.col("xml")))
    status = s.xml_status(docs, x.ROOT, x.WIDE)
    k = F.col("doc_id")
    rows = status.withColumns({"id_text": F.when(k % 21 == 0, "").when(k % 21 == 1, "x7").otherwise(k.cast("string")), "right": k % 8 != 0, "wrong": k % 9 == 0})
    return q.pre_validate(rows, F.col("id_text"), F.col("right"), F.col("wrong"), F.col("status"))


CHECKED = """SELECT o_orderkey AS doc_id,
  concat_ws(';', CASE o_orderkey % 50 WHEN 0 THEN 'structure:ends' WHEN 1 THEN 'structure:empty' WHEN 2 THEN 'structure:starts' WHEN 3 THEN 'structure:root' WHEN 4 THEN 'structure:well_formed' END,
    CASE WHEN o_orderkey % 21 = 0 THEN 'id:missing' END, CASE WHEN o_orderkey % 21 = 1 THEN 'id:not positive' END, CASE WHEN o_orderkey % 8 = 0 THEN 'product:missing' END) AS errors,
  CASE WHEN o_orderkey % 8 <> 0 AND o_orderkey % 9 = 0 THEN 'product:both' ELSE '' END AS warnings FROM orders"""


@query("pre_validate", f"SELECT *, errors = '' AS valid FROM ({CHECKED}) z")
def pre_validate(t):
    return checked(t)


@query(
    "batch_validation_summary",
    "SELECT count(*) AS documents, count(*) FILTER (WHERE errors = '') AS valid, count(*) FILTER (WHERE errors <> '') "
    "AS invalid, count(*) FILTER (WHERE warnings <> '') AS with_warnings, sum(CASE WHEN errors = '' THEN 0 ELSE len(string_split(errors, "
    f"';')) END)::BIGINT AS errors FROM ({CHECKED}) z",
)
def batch_validation_summary(t):
    return q.validation_summary(checked(t))


@query(
    "contact_checks",
    "WITH e AS (SELECT app_id, con_id, role, con_id % 7 <> 0 AS ok FROM contacts) SELECT o_orderkey AS doc_id, "
    "CAST(count(e.app_id) FILTER (WHERE NOT ok) AS INTEGER) AS missing_id, CAST(count(e.app_id) FILTER (WHERE role NOT IN "
    "('A', 'N')) AS INTEGER) AS bad_role, count(e.app_id) FILTER (WHERE ok AND role = 'A') = 0 AS no_primary, CAST(0 AS "
    "INTEGER) AS sparse_primary, CAST(greatest(0, count(e.app_id) FILTER (WHERE ok AND role = 'A') - 1) AS INTEGER) AS "
    "extra_primary, CAST(count(e.app_id) FILTER (WHERE ok) - count(DISTINCT e.con_id) FILTER (WHERE ok) AS INTEGER) AS "
    "duplicate_ids FROM orders LEFT JOIN e ON e.app_id = o_orderkey GROUP BY o_orderkey",
)
def contact_checks(t):
    """Over the shredded arrays; ids that 7 divides are blank here."""
    c = F.transform(
        "d.Request.CustData.application.contact",
        lambda e: e.withField("_con_id", F.when(e["_con_id"].cast("bigint") % 7 == 0, "").otherwise(e["_con_id"])),
    )
    needed = [f"{x.CONTACTS}.{name}" for name in ("_con_id", "_ac_role", "_first_name", "_amount")]
    docs = x.shredded(t, *needed).select("doc_id", c.alias("contacts"))
    return q.check_contacts(docs, "contacts", "_con_id", "_ac_role", ["A", "N"], ["_first_name", "_amount"])


@query(
    "child_checks",
    "SELECT app_id AS doc_id, 'address' AS table_name, 'type' AS field, 'child_type' AS \"check\", 'warning' AS severity, "
    "'skipped: no type' AS message FROM contacts WHERE line = 'O'",
)
def child_checks(t):
    rows = t.contacts.withColumn("type", F.when(F.col("line") != "O", F.col("line")))
    return q.check_children(rows, "app_id", "address", "type")


@query(
    "referential_integrity",
    "SELECT app_id AS doc_id, 'contact' AS table_name, 'supp' AS field, 'foreign_key' AS \"check\", 'critical' AS severity, "
    "'no parent' AS message FROM contacts WHERE supp NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey > 2)",
)
def referential_integrity(t):
    return q.check_fk(t.contacts, t.supplier.filter("s_nationkey > 2").select(F.col("s_suppkey").alias("supp")), "supp", "app_id", "contact")


REQUIRED = " UNION ALL ".join(SEVERE.format(f=f) for f in ("status_code", "zip"))


@query("required_fields", REQUIRED)
def required_fields(t):
    return q.check_required(t.codes, "app_id", "codes", ["status_code", "zip"])


@query(
    "type_conformance",
    "SELECT id AS doc_id, 'raw' AS table_name, 'num' AS field, 'type' AS \"check\", 'error' AS severity, 'not double' AS "
    "message FROM raw WHERE trim(num) <> '' AND try_cast(trim(num) AS DOUBLE) IS NULL",
)
def type_conformance(t):
    return q.check_types(t.raw, "id", "raw", {"num": "double"})


@query(
    "length_conformance",
    "SELECT id AS doc_id, 'raw' AS table_name, 'pr' AS field, 'length' AS \"check\", 'error' AS severity, 'over 8' AS "
    "message FROM raw WHERE length(pr) > 8",
)
def length_conformance(t):
    return q.check_lengths(t.raw, "id", "raw", {"pr": 8})


FORMATS = (
    "SELECT id AS doc_id, 'raw' AS table_name, 'ssn' AS field, 'format' AS \"check\", 'warning' AS severity, 'ssn' AS "
    "message FROM raw WHERE NOT regexp_matches(ssn, '^[0-9]{9}$') OR ssn = repeat(substr(ssn, 1, 1), 9) UNION ALL SELECT "
    "id, 'raw', 'email', 'format', 'warning', 'email' FROM raw WHERE email IS NOT NULL AND NOT (email LIKE '%@%' AND email "
    "LIKE '%.%') UNION ALL SELECT id, 'raw', 'phone', 'format', 'warning', 'phone' FROM raw WHERE phone IS NOT NULL AND "
    "length(regexp_replace(phone, '[^0-9]', '', 'g')) < 10 UNION ALL SELECT id, 'raw', 'd', 'format', 'warning', "
    "'birth_date' FROM raw WHERE year(CAST(d AS DATE)) > 1996"
)


@query("format_rules", FORMATS)
def format_rules(t):
    return q.check_formats(t.raw, "id", "raw", {"ssn": "ssn", "email": "email", "phone": "phone", "d": "birth_date"}, 2014)


@query(
    "source_consistency",
    "SELECT coalesce(o_orderkey, k) AS id, CASE WHEN k IS NULL THEN 'missing' WHEN o_orderkey IS NULL THEN 'unexpected' "
    "ELSE 'differs' END AS outcome, CASE WHEN k IS NULL OR o_orderkey IS NULL THEN '' ELSE 'p' END AS field FROM orders "
    "FULL JOIN (SELECT o_orderkey + CASE WHEN o_orderkey % 97 = 0 THEN 100000000 ELSE 0 END AS k, o_orderkey AS w FROM "
    "orders WHERE o_orderkey % 12 <> 0) s ON s.k = o_orderkey WHERE k IS NULL OR o_orderkey IS NULL OR w % 14 = 0",
)
def source_consistency(t):
    """Stored rows: each twelfth is missing, some have another id, each fourteenth another amount; text differs in case only."""
    stored = t.raw.filter("id % 12 <> 0").select(
        (F.col("id") + F.when(F.col("id") % 97 == 0, 100000000).otherwise(0)).alias("id"),
        (F.col("price") + F.when(F.col("id") % 14 == 0, 1.0).otherwise(0.001)).alias("p"), F.lower("pr").alias("pr"),
    )
    return q.check_source(t.raw.select("id", "p", "pr"), stored, "id", ["p", "pr"])


@query(
    "quality_metrics",
    "WITH m AS (SELECT 'status_code' AS column_name, round(100 * count(status_code) / count(*), 2) AS completeness, "
    "round(100 * count(*) FILTER (WHERE status_code IN ('F', 'O')) / count(status_code), 2) AS validity FROM codes UNION "
    "ALL SELECT 'zip', round(100 * count(zip) / count(*), 2), round(100 * count(*) FILTER (WHERE zip <> '00000') / "
    "count(zip), 2) FROM codes) SELECT *, CASE WHEN least(completeness, validity) >= 90 THEN 'good' WHEN "
    "least(completeness, validity) >= 80 THEN 'fair' ELSE 'poor' END AS grade FROM m",
)
def quality_metrics(t):
    return q.quality_metrics(t.codes, ["status_code", "zip"], {"status_code": F.col("status_code").isin("F", "O"), "zip": F.col("zip") != "00000"})


@query(
    "validation_verdict",
    "SELECT count(*) FILTER (WHERE severity IN ('critical', 'error')) = 0 AS passed, count(*) FILTER (WHERE severity = "
    "'critical') AS critical, count(*) FILTER (WHERE severity = 'error') AS error, count(*) FILTER (WHERE severity = 'warning') "
    f"AS warning FROM ({REQUIRED} UNION ALL {FORMATS}) z",
)
def validation_verdict(t):
    return q.verdict(required_fields(t).unionByName(format_rules(t)), strict=True)


@query(
    "validation_report",
    "SELECT table_name, \"check\", count(*) AS findings, count(DISTINCT doc_id) AS documents, round(100.0 * count(DISTINCT "
    f"doc_id) / (SELECT count(*) FROM orders), 2)::DOUBLE AS pct FROM ({REQUIRED} UNION ALL {FORMATS}) z GROUP BY 1, 2",
)
def validation_report(t):
    out = q.report(required_fields(t).unionByName(format_rules(t)), t.orders)
    return out.withColumn("pct", F.col("pct").cast("double"))


@query("primary_key_unique", "SELECT app_id, con_id, count(*) AS n FROM contacts GROUP BY app_id, con_id HAVING count(*) > 1")
def primary_key_unique(t):
    return q.check_unique(t.contacts, ["app_id", "con_id"])
