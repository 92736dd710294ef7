"""Analyst queries over the mapped tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import paging, relate
from .base import query

NOW = "1998-08-02"
BOARD = """WITH w AS (SELECT o.o_orderkey AS app_id, c.c_name AS name, o.o_orderpriority AS priority,
    CASE WHEN date_diff('day', CAST(o.o_orderdate AS DATE), DATE '1998-08-02') > 1000 THEN 'late' WHEN date_diff('day', CAST(o.o_orderdate AS DATE), DATE '1998-08-02') > 300 THEN 'due' ELSE 'fresh' END AS sla,
    EXISTS (SELECT 1 FROM contacts k WHERE k.app_id = o.o_orderkey AND k.role = 'R') AS returned,
    EXISTS (SELECT 1 FROM log l WHERE l.app_id = o.o_orderkey AND l.status = 'failed') AS failed
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey WHERE o.o_orderstatus <> 'F')
SELECT *, CASE WHEN failed THEN 'error' WHEN returned THEN 'review' ELSE 'open' END AS state, count(*) OVER () AS total FROM w ORDER BY priority, app_id LIMIT 100 OFFSET 50"""


def board(t, returned, failed):
    age = F.datediff(F.lit(NOW).cast("date"), F.to_date("o_orderdate"))
    rows = t.orders.filter("o_orderstatus <> 'F'").join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.select(
        F.col("o_orderkey").alias("app_id"), F.col("c_name").alias("name"), F.col("o_orderpriority").alias("priority"),
        F.when(age > 1000, "late").when(age > 300, "due").otherwise("fresh").alias("sla"),
    )
    return rows, relate.flag_exists(relate.flag_exists(rows, returned, "app_id", "returned"), failed, "app_id", "failed")


def paged(flagged, rows):
    state = F.when(F.col("failed"), "error").when(F.col("returned"), "review").otherwise("open")
    out = paging.with_total(flagged.select("app_id", "name", "priority", "sla", "returned", "failed", state.alias("state")), rows)
    return paging.page(out, ["priority", "app_id"], 50, 100)


@query("dashboard", BOARD)
def dashboard(t):
    """The worklist with correlated flags, which Catalyst turns into joins."""
    t.contacts.createOrReplaceTempView("board_contacts")
    t.log.createOrReplaceTempView("board_log")
    rows, _ = board(t, t.contacts, t.log)
    rows.createOrReplaceTempView("board_rows")
    flagged = t.spark.sql("SELECT *, EXISTS (SELECT 1 FROM board_contacts k WHERE k.app_id = r.app_id AND k.role = 'R') AS returned, EXISTS (SELECT 1 FROM board_log l WHERE l.app_id = r.app_id AND l.status = 'failed') AS failed FROM board_rows r")
    return paged(flagged, rows)


@query("dashboard_cte", BOARD)
def dashboard_cte(t):
    """The same rows from joins with distinct keys."""
    rows, flagged = board(t, t.contacts.filter("role = 'R'"), t.log.filter("status = 'failed'"))
    return paged(flagged, rows)


@query(
    "quick_search",
    "SELECT c_custkey, c_name, count(o_orderkey) AS n_orders, max(o_totalprice) AS largest FROM customer LEFT JOIN orders "
    "ON o_custkey = c_custkey WHERE upper(c_name) LIKE 'CUSTOMER#0000001%' OR right(CAST(c_custkey AS STRING), 2) = '42' "
    "GROUP BY c_custkey, c_name ORDER BY n_orders DESC, c_custkey LIMIT 50",
)
def quick_search(t):
    hit = t.customer.filter(F.upper("c_name").like("CUSTOMER#0000001%") | (F.right(F.col("c_custkey").cast("string"), F.lit(2)) == "42"))
    out = hit.join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left").groupBy("c_custkey", "c_name").agg(
        F.count("o_orderkey").alias("n_orders"), F.max("o_totalprice").alias("largest"),
    )
    return paging.page(out, [F.desc("n_orders"), "c_custkey"], 0, 50)


@query(
    "match_then_display",
    "WITH m AS (SELECT DISTINCT app_id FROM contacts WHERE qty >= 49 AND role = 'N') SELECT m.app_id, c_name, con_id, "
    "amount FROM m JOIN orders ON o_orderkey = m.app_id JOIN customer ON c_custkey = o_custkey LEFT JOIN (SELECT *, "
    "row_number() OVER (PARTITION BY app_id ORDER BY amount DESC, pos) AS k FROM contacts) t ON t.app_id = m.app_id AND k "
    "= 1 ORDER BY m.app_id LIMIT 200",
)
def match_then_display(t):
    """Matching ids first; only those of the page are decorated."""
    ids = paging.top_n(t.contacts.filter("qty >= 49 and role = 'N'").select("app_id").distinct(), ["app_id"], 200)
    people = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderkey").alias("app_id"), "c_name")
    lines = t.contacts.join(ids, "app_id", "left_semi")
    return relate.left_top1(ids.join(people, "app_id"), lines, "app_id", ["con_id", "amount"], F.desc("amount"), F.asc("pos")).orderBy("app_id")


@query(
    "wide_application",
    "SELECT o_orderkey AS app_id, c_name, a.value AS nation, p_name, s_name, b.value AS supplier_nation, con_id, pos FROM "
    "orders JOIN customer ON c_custkey = o_custkey LEFT JOIN enums a ON a.enum_id = c_nationkey JOIN contacts ON app_id = "
    "o_orderkey LEFT JOIN part ON p_partkey = con_id LEFT JOIN supplier ON s_suppkey = supp LEFT JOIN enums b ON b.enum_id "
    "= s_nationkey",
)
def wide_application(t):
    """One wide row for each application and contact, all codes decoded."""
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("app_id"), "c_name", F.col("c_nationkey").alias("home"),
    )
    rows = rows.join(t.contacts.select("app_id", "con_id", "pos", "supp"), "app_id")
    rows = rows.join(t.part.select(F.col("p_partkey").alias("con_id"), "p_name"), "con_id", "left")
    rows = rows.join(t.supplier.select(F.col("s_suppkey").alias("supp"), "s_name", F.col("s_nationkey").alias("away")), "supp", "left")
    return relate.decode_enums(rows, t.enums, {"home": "nation", "away": "supplier_nation"}).select(
        "app_id", "c_name", "nation", "p_name", "s_name", "supplier_nation", "con_id", "pos",
    )


#: Eighteen coded columns of a wide row, each with a code list of its own order.
LOOKUPS = {f"code_{i:02d}": f"(o_orderkey * {i} + c_nationkey) % {20 + i}" for i in range(1, 19)}


@query(
    "wide_decoded",
    f"WITH w AS (SELECT o_orderkey AS app_id, c_name, {', '.join(f'{e} AS {n}' for n, e in LOOKUPS.items())} FROM orders JOIN customer ON c_custkey = o_custkey) SELECT app_id, c_name, "
    f"{', '.join(f'{n}_t.value AS {n}_name' for n in LOOKUPS)} FROM w {' '.join(f'LEFT JOIN enums {n}_t ON {n}_t.enum_id = w.{n}' for n in LOOKUPS)}",
)
def wide_decoded(t):
    """A wide row with eighteen codes, all decoded in one pass by one broadcast row."""
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderkey").alias("app_id"), "c_name", *[F.expr(e).alias(n) for n, e in LOOKUPS.items()])
    return relate.decode_enums(rows, t.enums, {n: f"{n}_name" for n in LOOKUPS}).select("app_id", "c_name", *[f"{n}_name" for n in LOOKUPS])
