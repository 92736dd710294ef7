"""Joins, pages and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import paging as g
from ..operators import relate as r
from .base import query


@query(
    "one_row_per_app",
    "SELECT o.o_orderkey AS app_id, c.c_mktsegment, l.con_id, l.pos, s.s_name FROM orders o LEFT JOIN customer c ON "
    "o.o_custkey = c.c_custkey JOIN contacts l ON l.app_id = o.o_orderkey LEFT JOIN supplier s ON l.supp = s.s_suppkey AND "
    "s.s_nationkey < 15",
)
def one_row_per_app(t):
    base = t.orders.select(F.col("o_orderkey").alias("app_id"), F.col("o_custkey").alias("cust"))
    ones = base.join(t.customer.select(F.col("c_custkey").alias("cust"), "c_mktsegment"), "cust", "left").select("app_id", "c_mktsegment")
    contacts = t.contacts.select("app_id", "con_id", "pos", "supp")
    out = r.wide_row(base.select("app_id"), [ones], contacts, [(t.supplier.withColumnRenamed("s_suppkey", "supp"), F.col("s_nationkey") < 15)], "app_id", "supp")
    return out.select("app_id", "c_mktsegment", "con_id", "pos", "s_name")


@query(
    "enum_decode",
    "SELECT c_custkey, a.value AS nation, b.value AS twin FROM customer LEFT JOIN enums a ON a.enum_id = c_nationkey LEFT "
    "JOIN enums b ON b.enum_id = (c_nationkey * 2) % 40",
)
def enum_decode(t):
    rows = t.customer.select("c_custkey", "c_nationkey", ((F.col("c_nationkey") * 2) % 40).alias("other"))
    return r.decode_enums(rows, t.enums, {"c_nationkey": "nation", "other": "twin"}).select("c_custkey", "nation", "twin")


@query(
    "default_audit_join",
    "SELECT c.app_id, c.state, c.zip, l.status FROM codes c LEFT JOIN log l ON c.app_id = l.app_id WHERE c.state = 'XX' OR "
    "c.zip = '00000' OR c.priority_code = 'UNKNOWN'",
)
def default_audit_join(t):
    return r.audit_defaults(t.codes, t.log, {"state": "XX", "zip": "00000", "priority_code": "UNKNOWN"}, "app_id").select("app_id", "state", "zip", "status")


@query(
    "default_audit_all",
    "WITH c AS (SELECT app_id, state, zip, priority_code FROM codes), b AS (SELECT app_id, con_id, line FROM contacts WHERE pos = 0), f AS (SELECT app_id, con_id AS first_con, supp FROM contacts WHERE pos = 0), "
    "u AS (SELECT o_orderkey AS app_id, c_mktsegment FROM orders JOIN customer ON c_custkey = o_custkey), s AS (SELECT f.app_id, s_nationkey FROM f JOIN supplier ON s_suppkey = supp), "
    "p AS (SELECT f.app_id, p_size FROM f JOIN part ON p_partkey = first_con), e AS (SELECT app_id, value FROM stored WHERE name = 'extra'), x AS (SELECT app_id, value FROM expected WHERE name = 'alpha') "
    "SELECT o_orderkey AS app_id, o_orderstatus, c.state AS codes_state, c.zip AS codes_zip, c.priority_code AS codes_priority_code, b.con_id AS contact_con_id, b.line AS contact_line, l.status AS log_status, "
    "u.c_mktsegment AS customer_c_mktsegment, s.s_nationkey AS supplier_s_nationkey, p.p_size AS part_p_size, e.value AS extra_value, x.value AS alpha_value, concat_ws(',', CASE WHEN state = 'XX' THEN 'codes_state' "
    "END, CASE WHEN zip = '00000' THEN 'codes_zip' END, CASE WHEN priority_code = 'UNKNOWN' THEN 'codes_priority_code' END, CASE WHEN s_nationkey = 3 THEN 'supplier_s_nationkey' END, CASE WHEN p_size = 1 THEN "
    "'part_p_size' END, CASE WHEN e.value = 7 THEN 'extra_value' END) AS defaults FROM orders LEFT JOIN c ON c.app_id = o_orderkey LEFT JOIN b ON b.app_id = o_orderkey LEFT JOIN log l ON l.app_id = o_orderkey "
    "LEFT JOIN u ON u.app_id = o_orderkey LEFT JOIN s ON s.app_id = o_orderkey LEFT JOIN p ON p.app_id = o_orderkey LEFT JOIN e ON e.app_id = o_orderkey LEFT JOIN x ON x.app_id = o_orderkey WHERE state = 'XX' OR "
    "zip = '00000' OR priority_code = 'UNKNOWN' OR s_nationkey = 3 OR p_size = 1 OR e.value = 7",
)
def default_audit_all(t):
    """Eight tables beside a document's base row, where any of four has a known default."""
    base = t.orders.select(F.col("o_orderkey").alias("app_id"), "o_orderstatus", F.col("o_custkey").alias("_cust"))
    first = t.contacts.filter("pos = 0")
    by = lambda other, key, on, col: first.join(other.select(F.col(key).alias(on), col), on).select("app_id", col)
    tables = {
        "codes": (t.codes, ["state", "zip", "priority_code"], {"state": "XX", "zip": "00000", "priority_code": "UNKNOWN"}), "contact": (first, ["con_id", "line"], {}), "log": (t.log, ["status"], {}),
        "customer": (base.join(t.customer.select(F.col("c_custkey").alias("_cust"), "c_mktsegment"), "_cust").select("app_id", "c_mktsegment"), ["c_mktsegment"], {}),
        "supplier": (by(t.supplier, "s_suppkey", "supp", "s_nationkey"), ["s_nationkey"], {"s_nationkey": 3}), "part": (by(t.part, "p_partkey", "con_id", "p_size"), ["p_size"], {"p_size": 1}),
        "extra": (t.stored.filter("name = 'extra'"), ["value"], {"value": 7}), "alpha": (t.expected.filter("name = 'alpha'"), ["value"], {}),
    }
    return r.audit_join(base.drop("_cust"), tables, "app_id")


@query("orphan_guard", "SELECT app_id, pos FROM contacts WHERE app_id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')")
def orphan_guard(t):
    parents = t.orders.filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("app_id"))
    return r.with_parent(t.contacts, parents, "app_id").select("app_id", "pos")


@query("exists_join", "SELECT o_orderkey AS app_id FROM orders WHERE NOT EXISTS (SELECT 1 FROM contacts WHERE app_id = o_orderkey AND role = 'R')")
def exists_join(t):
    return r.where_exists(t.orders.select(F.col("o_orderkey").alias("app_id")), t.contacts.filter("role = 'R'"), "app_id", negate=True)


@query("scalar_subquery", "SELECT o_orderkey AS app_id, (SELECT count(*) FROM contacts WHERE app_id = o_orderkey AND qty > 45) > 0 AS large FROM orders")
def scalar_subquery(t):
    return r.flag_exists(t.orders.select(F.col("o_orderkey").alias("app_id")), t.contacts.filter("qty > 45"), "app_id", "large").select("app_id", "large")


@query(
    "outer_apply_top1",
    "SELECT o_orderkey AS app_id, con_id, amount FROM orders LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY app_id "
    "ORDER BY amount DESC, pos) AS k FROM contacts) c ON c.app_id = o_orderkey AND k = 1",
)
def outer_apply_top1(t):
    return r.left_top1(t.orders.select(F.col("o_orderkey").alias("app_id")), t.contacts, "app_id", ["con_id", "amount"], F.desc("amount"), F.asc("pos"))


@query(
    "update_from_join",
    "SELECT c.app_id, CASE WHEN s.n > 5 THEN 'many' ELSE c.state END AS state FROM codes c LEFT JOIN (SELECT app_id, "
    "count(*) AS n FROM contacts GROUP BY app_id) s ON c.app_id = s.app_id",
)
def update_from_join(t):
    source = t.contacts.groupBy("app_id").agg(F.count("*").alias("n")).select("app_id", F.when(F.col("n") > 5, "many").alias("state"))
    return r.update_from(t.codes.select("app_id", "state"), source, "app_id", "state")


@query("lookup_inner_guard", "SELECT app_id, priority_code FROM codes WHERE priority_code IN (SELECT DISTINCT substr(o_orderpriority, 1, 1) FROM orders)")
def lookup_inner_guard(t):
    known = t.orders.select(F.substring("o_orderpriority", 1, 1).alias("priority_code")).distinct()
    return r.only_known(t.codes.select("app_id", "priority_code"), known, "priority_code").select("app_id", "priority_code")


@query("required_enum_anti", "SELECT CAST(x AS INTEGER) AS enum_id FROM (VALUES (3), (24), (25), (77)) v(x) WHERE x NOT IN (SELECT enum_id FROM enums)")
def required_enum_anti(t):
    return r.missing_codes(t.enums, [3, 24, 25, 77])


@query("total_over", "SELECT app_id, con_id, count(*) OVER () AS total FROM contacts WHERE role = 'R'")
def total_over(t):
    return g.with_total(t.contacts.filter("role = 'R'").select("app_id", "con_id"))


@query("page_offset", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 100")
def page_offset(t):
    return g.page(t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 100, 50)


@query("top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top_n(t):
    return g.top_n(t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 20)


@query("random_sample", "SELECT o_orderkey FROM orders ORDER BY (o_orderkey * 48271) % 2147483647, o_orderkey LIMIT 100")
def random_sample(t):
    return g.sample_n(t.orders.select("o_orderkey"), "o_orderkey", 100, 48271)


@query("seeded_sample", "SELECT o_orderkey FROM orders ORDER BY md5(concat('17:', CAST(o_orderkey AS VARCHAR))), o_orderkey LIMIT 100")
def seeded_sample(t):
    return g.sample_seeded(t.orders.select("o_orderkey"), "o_orderkey", 100, 17)


@query("distinct_rows", "SELECT DISTINCT con_id, role FROM contacts")
def distinct_rows(t):
    return g.distinct(t.contacts, ["con_id", "role"])


@query(
    "union_suspects",
    "SELECT app_id FROM codes WHERE state = 'XX' UNION SELECT app_id FROM codes WHERE zip = '00000' UNION SELECT app_id "
    "FROM log WHERE status = 'failed'",
)
def union_suspects(t):
    return g.union_ids(
        t.codes.filter("state = 'XX'").select("app_id"), t.codes.filter("zip = '00000'").select("app_id"),
        t.log.filter("status = 'failed'").select("app_id"),
    )


@query(
    "set_difference",
    "SELECT app_id, name, 'missing' AS side FROM (SELECT app_id, name FROM expected EXCEPT SELECT app_id, name FROM "
    "stored) a UNION ALL SELECT app_id, name, 'extra' FROM (SELECT app_id, name FROM stored EXCEPT SELECT app_id, name "
    "FROM expected) b",
)
def set_difference(t):
    a, b, keys = t.expected.select("app_id", "name"), t.stored.select("app_id", "name"), ["app_id", "name"]
    return g.difference(a, b, keys).withColumn("side", F.lit("missing")).unionByName(g.difference(b, a, keys).withColumn("side", F.lit("extra")))


@query(
    "values_union",
    "SELECT o_orderstatus AS code, label, count(*) AS n FROM orders JOIN (VALUES ('F', 'final'), ('O', 'open'), ('P', "
    "'partial')) v(code, label) ON o_orderstatus = code GROUP BY 1, 2",
)
def values_union(t):
    names = g.inline(t.spark, [("F", "final"), ("O", "open"), ("P", "partial")], "code string, label string")
    return t.orders.withColumnRenamed("o_orderstatus", "code").join(names, "code").groupBy("code", "label").agg(F.count("*").alias("n"))
