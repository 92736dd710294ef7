"""Registry of queries, the driver tables, and inputs that Spark and the oracle derive from them by the same SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

LINES = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"

#: An order's columns, and what `raw` makes of them.
ORDER = """o_orderkey AS id, o_custkey AS cust, o_orderstatus AS st, o_orderpriority AS pr, o_totalprice AS price,
              CAST(CAST(o_orderdate AS DATE) AS STRING) AS d, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING) AS p"""
RAW = """id, cust, st, pr, price, d, p,
        CASE id % 7 WHEN 0 THEN '' WHEN 1 THEN 'abc' WHEN 2 THEN concat(' 1,', CAST(id % 900 + 100 AS STRING), '.5 ') WHEN 3 THEN NULL WHEN 4 THEN concat('-', p) ELSE p END AS num,
        CASE id % 6 WHEN 0 THEN concat(d, ' 08:46:18.55') WHEN 1 THEN d WHEN 2 THEN concat(substr(d, 6, 2), '/', substr(d, 9, 2), '/', substr(d, 1, 4))
          WHEN 3 THEN concat(substr(d, 6, 2), '/', substr(d, 9, 2), '/', substr(d, 1, 4), ' 13:05:09') WHEN 4 THEN concat(d, ' 23:59:88') ELSE 'junk' END AS dt,
        CASE id % 8 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' WHEN 2 THEN 'y' WHEN 3 THEN '' WHEN 4 THEN NULL WHEN 5 THEN 'X' WHEN 6 THEN ' ' ELSE 'true' END AS flag,
        CASE id % 5 WHEN 0 THEN concat('  ', pr, '   ', st, ' ') WHEN 1 THEN '' WHEN 2 THEN 'null' WHEN 3 THEN NULL ELSE concat(pr, ' ', st) END AS txt,
        CASE id % 4 WHEN 0 THEN concat('(', CAST(100 + id % 900 AS STRING), ') 555-', CAST(1000 + id % 9000 AS STRING)) WHEN 1 THEN concat('tel ', CAST(id AS STRING)) WHEN 2 THEN NULL ELSE 'none' END AS phone,
        CASE id % 3 WHEN 0 THEN CAST(100000000 + id AS STRING) WHEN 1 THEN '111111111' ELSE CAST(id AS STRING) END AS ssn,
        CASE id % 3 WHEN 0 THEN concat('u', CAST(id AS STRING), '@mail.example') WHEN 1 THEN 'nobody' ELSE NULL END AS email"""

#: Stand-ins for the engine's inputs, in SQL that Spark and DuckDB read alike.
INPUTS = {
    # one row per order, as raw text in the ways that source attributes come
    "raw": f"""SELECT {RAW}
      FROM (SELECT {ORDER} FROM orders) b""",
    # repeated elements in a total document order
    "contacts": f"""SELECT l_orderkey AS app_id, l_partkey AS con_id, l_returnflag AS role, l_suppkey AS supp, l_linestatus AS line, CAST(l_linenumber AS INT) AS n,
        l_quantity AS qty, l_extendedprice AS amount, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINES}) - 1 AS INT) AS pos FROM lineitem""",
    "log": """SELECT o_orderkey AS app_id, CASE WHEN o_orderkey % 7 = 0 THEN 'failed' ELSE 'success' END AS status,
        CASE WHEN o_orderkey % 7 = 0 THEN concat(CASE o_orderkey % 3 WHEN 0 THEN 'parsing' WHEN 1 THEN 'mapping' ELSE 'database' END, ': row ', CAST(o_orderkey AS STRING)) END AS failure_reason,
        concat('s', CAST(o_orderkey % 4 AS STRING)) AS session_id FROM orders WHERE o_orderkey % 5 <> 0""",
    # codes: nulls, markers and unknown ones by rule
    "codes": """SELECT o_orderkey AS app_id, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS status_code,
        CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 13 = 1 THEN 'UNKNOWN' ELSE substr(o_orderpriority, 1, 1) END AS priority_code,
        CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice END AS amount, CASE WHEN o_orderkey % 17 = 0 THEN 'XX' ELSE 'OH' END AS state,
        CASE WHEN o_orderkey % 19 = 0 THEN '00000' WHEN o_orderkey % 19 = 1 THEN NULL ELSE CAST(10000 + o_custkey % 80000 AS STRING) END AS zip, CAST(NULL AS STRING) AS never FROM orders""",
    # key-value rows that mapping expects, and what is stored: some missing, some different, some beyond
    "expected": """SELECT o_orderkey AS app_id, CAST(k AS STRING) AS name, CAST(CAST(o_totalprice AS DECIMAL(12,0)) AS BIGINT) + j AS value
        FROM orders, (SELECT 'alpha' AS k, 1 AS j UNION ALL SELECT 'beta', 2 UNION ALL SELECT 'gamma', 3) s WHERE (o_orderkey + j) % 4 <> 0""",
    "stored": """SELECT app_id, name, CASE WHEN app_id % 23 = 0 THEN value + 1 ELSE value END AS value FROM expected WHERE (app_id % 10 <> 3 OR name <> 'beta')
        UNION ALL SELECT o_orderkey, 'extra', CAST(7 AS BIGINT) FROM orders WHERE o_orderkey % 29 = 0""",
    "metrics": """SELECT event_id AS item, event_type AS run, user_id % 16 AS chunk, value AS seconds, CAST(user_id % 4 AS INT) AS batch FROM events""",
    "enums": """SELECT CAST(n_nationkey AS INT) AS enum_id, concat('type_', CAST(n_regionkey AS STRING)) AS type, n_name AS value FROM nation""",
}


class Tables:
    """The tables of a folder, as attributes; sql() sees them and the inputs as views."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        if name in INPUTS:
            return self.sql(f"SELECT * FROM {name}")
        raise AttributeError(name)

    def sql(self, text: str) -> DataFrame:
        text = with_inputs(text)
        for name in TABLES:
            if re.search(rf"\b{name}\b", text):
                getattr(self, name).createOrReplaceTempView(name)
        return self.spark.sql(text)


def with_inputs(text: str) -> str:
    """The SQL with a WITH clause for the inputs that it names."""
    names: list[str] = []

    def need(sql: str) -> None:
        for name in INPUTS:
            if name not in names and re.search(rf"\b(?:FROM|JOIN|,)\s+{name}\b", sql, re.I):
                need(INPUTS[name])
                if name not in names:
                    names.append(name)

    need(text)
    if not names:
        return text
    head = ", ".join(f"{n} AS ({INPUTS[n]})" for n in names)
    own = re.match(r"\s*WITH\s+", text, re.I)
    return f"WITH {head}, {text[own.end():]}" if own else f"WITH {head} {text}"


def query(key: str, sql: str | None = None):
    """Register f(tables) under a key, and its oracle if SQL can express it."""

    def put(f: Callable[[Tables], DataFrame]):
        assert key not in QUERIES, key
        QUERIES[key] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            ORACLE[key] = with_inputs(sql)
        return f

    return put
