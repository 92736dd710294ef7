"""Calculated columns. Each expression is compiled once to a Column."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calculated import calc
from ..operators.reconcile import verify_calc
from .base import query

P = "CAST(p AS DOUBLE)"


def compiled(key: str, expression: str, sql: str, type: str = "string") -> None:
    @query(key, f"SELECT id, {sql} AS out FROM raw")
    def run(t):
        out = calc(expression, lambda name: F.col(name.split(".")[-1].lower()).cast("string"))
        return t.raw.select("id", (F.round(out, 4) if type == "double" else out).cast(type).alias("out"))


compiled(
    "calc_arith", "(price * 2 + num) / (id % 3) - 2 ** 3 + id // 7",
    "round(CASE WHEN num IS NULL OR trim(num) = '' OR try_cast(replace(trim(num), ',', '') AS DOUBLE) IS NULL OR id % 3 = 0 THEN NULL ELSE (price * 2 + try_cast(replace(trim(num), ',', '') AS DOUBLE)) / (id % 3) - 8 + id // 7 END, 4)",
    "double",
)
compiled(
    "calc_case", "CASE WHEN st = 'F' THEN 'final' WHEN price > 150000 THEN 'large' ELSE 'open' END",
    "CASE WHEN st = 'F' THEN 'final' WHEN price > 150000 THEN 'large' ELSE 'open' END",
)
compiled(
    "calc_logic", "CASE WHEN st = 'F' OR st = 'O' AND price < 100000 THEN 'yes' ELSE 'no' END",
    "CASE WHEN st = 'F' OR (st = 'O' AND price < 100000) THEN 'yes' ELSE 'no' END",
)
compiled(
    "calc_compare", "CASE WHEN num >= 1000 THEN 'ge' WHEN num <> 'abc' THEN 'ne' ELSE 'no' END",
    "CASE WHEN num IS NULL OR num = '' THEN 'no' WHEN coalesce(try_cast(trim(num) AS DOUBLE), 0) >= 1000 THEN 'ge' WHEN (try_cast(trim(num) AS DOUBLE) IS NOT NULL AND try_cast(trim(num) AS DOUBLE) <> 0) OR (try_cast(trim(num) AS DOUBLE) IS NULL AND num <> 'abc') THEN 'ne' ELSE 'no' END",
)
compiled(
    "calc_like", "CASE WHEN pr LIKE '_-med%' THEN 'medium' WHEN pr NOT LIKE '%H%' THEN 'noh' ELSE 'h' END",
    "CASE WHEN pr ILIKE '_-med%' THEN 'medium' WHEN pr NOT ILIKE '%H%' THEN 'noh' ELSE 'h' END",
)
compiled(
    "calc_empty", "CASE WHEN flag IS NULL THEN 'null' WHEN flag IS EMPTY THEN 'empty' WHEN flag IS NOT EMPTY THEN 'full' END",
    "CASE WHEN coalesce(flag, '') = '' THEN 'null' WHEN trim(flag) = '' THEN 'empty' ELSE 'full' END",
)
compiled(
    "calc_date", "CASE WHEN DATE(dt) < DATE('1995-06-17') THEN 'before' WHEN DATE(dt) IS NULL THEN 'none' ELSE 'after' END",
    "CASE WHEN id % 6 = 5 OR id % 6 = 4 THEN 'none' WHEN CAST(d AS DATE) < DATE '1995-06-17' THEN 'before' ELSE CASE WHEN id % 6 IN (0, 3) AND CAST(d AS DATE) < DATE '1995-06-17' THEN 'before' ELSE 'after' END END",
)
compiled("calc_dateadd", "DATEADD(day, id, DATE('1990-01-01'))", "CASE WHEN id BETWEEN date_diff('day', DATE '1990-01-01', DATE '0001-01-01') AND date_diff('day', DATE '1990-01-01', DATE '9999-12-31') THEN CAST(DATE '1990-01-01' + CAST(id AS INTEGER) AS STRING) END")
compiled("calc_crossref", "CASE WHEN application.ST = 'P' AND contact.Price > 1 THEN 'both' END", "CASE WHEN st = 'P' AND price > 1 THEN 'both' END")


@query("calc_verify", "SELECT count(*) FILTER (WHERE id % 10 <> 0) AS passed, count(*) FILTER (WHERE id % 10 = 0) AS failed FROM raw")
def calc_verify(t):
    """The stored column is wrong in each tenth row."""
    again = calc("price * 2", lambda n: F.col(n).cast("string"))
    rows = t.raw.withColumn("stored", F.when(F.col("id") % 10 == 0, F.col("price") + 1).otherwise(F.col("price") * 2))
    return verify_calc(rows, "stored", again)
