"""The relational twin: target tables straight from source tables, each as one set-based query."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import casts as c
from ..operators import pick, relate
from .base import query


def base(t):
    return t.raw.select(F.col("id").alias("app_id"), "cust", "st", "pr", "price", "d", "dt", "num", "flag", "txt", "phone")


@query(
    "rel_base",
    "SELECT id AS app_id, CASE WHEN st = 'F' THEN 1 WHEN st = 'O' THEN 2 ELSE 9 END AS status_enum, CASE WHEN rtrim(pr) IN "
    "('1-URGENT', '2-HIGH') THEN 10 ELSE 20 END AS type_enum, CASE WHEN id % 6 = 5 THEN '2024-01-01' ELSE d END AS "
    "received, c_mktsegment AS segment FROM raw LEFT JOIN customer ON c_custkey = cust",
)
def rel_base(t):
    """Coded columns, and the run's date where none was given."""
    received = F.coalesce(F.when(F.col("dt") != "junk", F.col("d")), F.lit("2024-01-01"))
    rows = base(t).join(t.customer.select(F.col("c_custkey").alias("cust"), F.col("c_mktsegment").alias("segment")), "cust", "left")
    return rows.select(
        "app_id", c.code_map(F.col("st"), [(["F"], 1), (["O"], 2)], 9).alias("status_enum"),
        c.code_map(F.col("pr"), [(["1-URGENT", "2-HIGH"], 10)], 20).alias("type_enum"), received.alias("received"), "segment",
    )


@query(
    "rel_operational",
    "SELECT id AS app_id, CASE WHEN d < '1995-01-01' AND st = 'F' THEN 'old final' WHEN d < '1995-01-01' THEN 'old' WHEN "
    "st = 'P' THEN 'partial' ELSE 'new' END AS population, m.supp AS last_source, p.amount AS top_amount FROM raw LEFT "
    "JOIN (SELECT app_id, arg_max(supp, pos) AS supp FROM contacts GROUP BY app_id) m ON m.app_id = id LEFT JOIN (SELECT "
    "app_id, max(amount) AS amount FROM contacts WHERE line = 'O' GROUP BY app_id) p ON p.app_id = id",
)
def rel_operational(t):
    """A date cutoff by population, the newest source, the largest amount at a current address."""
    population = F.when((F.col("d") < "1995-01-01") & (F.col("st") == "F"), "old final").when(F.col("d") < "1995-01-01", "old").when(F.col("st") == "P", "partial").otherwise("new")
    newest = pick.latest(t.contacts, "app_id", "pos", "supp").withColumnRenamed("supp", "last_source")
    top = t.contacts.filter("line = 'O'").groupBy("app_id").agg(F.max("amount").alias("top_amount"))
    return base(t).select("app_id", population.alias("population")).join(newest, "app_id", "left").join(top, "app_id", "left")


@query(
    "rel_transactional",
    "SELECT id AS app_id, CASE WHEN upper(trim(flag)) = 'Y' THEN 1 ELSE 0 END AS signed, CASE WHEN l.app_id IS NULL THEN 0 "
    "ELSE 1 END AS logged, CASE WHEN l.status = 'failed' THEN 1 ELSE 0 END AS failed FROM raw LEFT JOIN log l ON l.app_id "
    "= id",
)
def rel_transactional(t):
    rows = base(t).join(t.log.select("app_id", "status"), "app_id", "left")
    return rows.select(
        "app_id", c.char_to_bit(F.col("flag"), {"Y": 1, "N": 0}).alias("signed"),
        F.when(F.col("status").isNull(), 0).otherwise(1).alias("logged"),
        F.when(F.col("status") == "failed", 1).otherwise(0).alias("failed"),
    )


@query(
    "rel_pricing",
    "SELECT app_id, pos, con_id, ((2 * CAST(round(amount * 100) AS BIGINT) + CAST(qty AS BIGINT)) // (2 * CAST(qty AS "
    "BIGINT))) / 100.0 AS unit, p_retailprice AS list_price FROM contacts JOIN part ON p_partkey = con_id AND p_size > 10",
)
def rel_pricing(t):
    """Rows of unknown parts go: the lookup is a guard."""
    known = t.part.filter("p_size > 10").select(F.col("p_partkey").alias("con_id"), F.col("p_retailprice").alias("list_price"))
    unit = F.round(F.col("amount").cast("decimal(12,2)") / F.col("qty").cast("decimal(5,0)"), 2).cast("double")
    return t.contacts.join(known, "con_id").select("app_id", "pos", "con_id", unit.alias("unit"), "list_price")


@query(
    "rel_solicited",
    "SELECT id AS app_id, rtrim(c_name) AS name, n_name AS place, CASE WHEN id % 6 <> 5 THEN d END AS birth_date FROM raw "
    "JOIN customer ON c_custkey = cust LEFT JOIN nation ON n_nationkey = c_nationkey WHERE st <> 'P'",
)
def rel_solicited(t):
    people = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("cust"), F.rtrim("c_name").alias("name"), F.col("n_name").alias("place"),
    )
    return base(t).filter("st <> 'P'").join(people, "cust").select(
        "app_id", "name", "place", F.when(F.col("dt") != "junk", c.date_or(F.col("d")).cast("string")).alias("birth_date"),
    )


@query(
    "rel_contacts",
    "SELECT app_id, con_id, pos, CASE role WHEN 'A' THEN 10 WHEN 'N' THEN 11 ELSE 12 END AS type_enum, coalesce(s_name, "
    "'MISSING') AS last_name, right(CAST(con_id AS STRING), 4) AS last4 FROM contacts LEFT JOIN supplier ON s_suppkey = "
    "supp AND s_acctbal > 0",
)
def rel_contacts(t):
    names = t.supplier.filter("s_acctbal > 0").select(F.col("s_suppkey").alias("supp"), "s_name")
    return t.contacts.join(names, "supp", "left").select(
        "app_id", "con_id", "pos", c.code_map(F.col("role"), [(["A"], 10), (["N"], 11)], 12).alias("type_enum"),
        F.coalesce("s_name", F.lit("MISSING")).alias("last_name"), c.last_n(F.col("con_id").cast("string"), 4).alias("last4"),
    )


@query(
    "rel_addresses",
    "SELECT app_id, con_id, pos, CASE WHEN line = 'O' THEN 'CURR' ELSE 'PREV' END AS address_type, CAST(n * 12 + 3 AS "
    "SMALLINT) AS months FROM contacts WHERE app_id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')",
)
def rel_addresses(t):
    kept = relate.with_parent(t.contacts, t.orders.filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("app_id")), "app_id")
    return kept.select(
        "app_id", "con_id", "pos", F.when(F.col("line") == "O", "CURR").otherwise("PREV").alias("address_type"),
        c.months(F.lit(3), F.col("n")).alias("months"),
    )


@query(
    "rel_employment",
    "SELECT app_id, con_id, pos, left(replace(p_name, ' ', ''), 10) AS business, CASE WHEN n % 2 = 0 THEN ((2 * "
    "CAST(round(amount * 100) AS BIGINT) + 12) // 24) / 100.0 ELSE CAST(round(amount * 100) AS BIGINT) / 100.0 END AS "
    "monthly_salary FROM contacts JOIN part ON p_partkey = con_id",
)
def rel_employment(t):
    rows = t.contacts.join(t.part.select(F.col("p_partkey").alias("con_id"), "p_name"), "con_id")
    basis = F.when(F.col("n") % 2 == 0, "ANNUAL").otherwise("MONTH")
    return rows.select(
        "app_id", "con_id", "pos", c.strip_punct(F.col("p_name"), 10).alias("business"),
        c.monthly(F.col("amount").cast("decimal(12,2)"), basis, {"ANNUAL": (1, 12), "MONTH": (1, 1)}).cast("double").alias("monthly_salary"),
    )


@query(
    "rel_funding",
    "SELECT id AS app_id, CASE WHEN s.n >= 3 THEN 'checked' WHEN l.status = 'failed' THEN 'held' ELSE 'open' END AS state, "
    "coalesce(s.total, price) AS funded FROM raw LEFT JOIN (SELECT app_id, count(*) AS n, round(sum(amount), 2) AS total "
    "FROM contacts WHERE role = 'R' GROUP BY app_id) s ON s.app_id = id LEFT JOIN log l ON l.app_id = id",
)
def rel_funding(t):
    """Two updates in turn: from the log, then from the returned lines."""
    rows = base(t).select("app_id", F.lit("open").alias("state"), F.col("price").alias("funded"))
    lines = t.contacts.filter("role = 'R'").groupBy("app_id").agg(F.count("*").alias("n"), F.round(F.sum("amount"), 2).alias("funded"))
    held = relate.update_from(rows, t.log.select("app_id", F.when(F.col("status") == "failed", "held").alias("state")), "app_id", "state")
    done = relate.update_from(held, lines.select("app_id", F.when(F.col("n") >= 3, "checked").alias("state")), "app_id", "state")
    return relate.update_from(done, lines, "app_id", "funded").select("app_id", "state", "funded")


@query(
    "rel_dealer",
    "SELECT id AS app_id, c_name AS dealer, CASE WHEN c_acctbal < 0 THEN 'debit' WHEN c_acctbal < 5000 THEN 'small' ELSE "
    "'large' END AS class, r_name AS region FROM raw LEFT JOIN customer ON c_custkey = cust LEFT JOIN nation ON "
    "n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey",
)
def rel_dealer(t):
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("region"))
    dealers = t.customer.join(places, "c_nationkey", "left").select(
        F.col("c_custkey").alias("cust"), F.col("c_name").alias("dealer"),
        F.when(F.col("c_acctbal") < 0, "debit").when(F.col("c_acctbal") < 5000, "small").otherwise("large").alias("class"), "region",
    )
    return base(t).select("app_id", "cust").join(dealers, "cust", "left").select("app_id", "dealer", "class", "region")


@query(
    "rel_slots_rows",
    "SELECT id AS app_id, 'warranty' AS kind, num AS value FROM raw WHERE coalesce(trim(num), '') <> '' UNION ALL SELECT "
    "id, 'exception', flag FROM raw WHERE upper(trim(flag)) = 'Y' UNION ALL SELECT id, 'lookup', txt FROM raw WHERE "
    "lower(trim(txt)) NOT IN ('', 'null', 'none')",
)
def rel_slots_rows(t):
    """One pass over the source instead of a union of scans."""
    items = F.array(
        F.when(c.nonblank(F.col("num")), F.struct(F.lit("warranty").alias("kind"), F.col("num").alias("value"))),
        F.when(F.upper(F.trim("flag")) == "Y", F.struct(F.lit("exception").alias("kind"), F.col("flag").alias("value"))),
        F.when(c.meaningful(F.col("txt")), F.struct(F.lit("lookup").alias("kind"), F.col("txt").alias("value"))),
    )
    return base(t).select("app_id", F.explode(F.array_compact(items)).alias("_x")).select("app_id", "_x.*")
