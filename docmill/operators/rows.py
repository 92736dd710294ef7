"""Mappings that make rows: columns to key-value rows, and groups or numbered slots to a row each."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import meaningful, nonblank


def kv_rows(df: DataFrame, id: str, specs: list[tuple[str, ...]], kind: str) -> DataFrame:
    """Rows of a key-value table from (column, name) pairs, in one pass. A third part is shown instead of the column's name
    by history, and is the source_report_key of report.

    score: (id, score_identifier, score), nothing where the number is null; indicator: (id, indicator, '1') where truthy;
    history: (id, name, source, value) and report: (id, name, value) where meaningful.
    """
    keyed = any(len(x) > 2 for x in specs) and kind == "report"
    specs = [(*x, x[0] if kind == "history" else None)[:3] for x in specs]
    items = F.array(*[F.struct(F.lit(shown).cast("string").alias("c"), F.lit(n).alias("n"), F.col(c).cast("string").alias("v")) for c, n, shown in specs])
    rows = df.select(F.col(id), F.explode(items).alias("_r")).select(id, "_r.*")
    if kind == "score":
        score = F.round(F.trim("v").try_cast("decimal(38,10)"), 0).try_cast("int")
        return rows.select(id, F.col("n").alias("score_identifier"), score.alias("score")).filter("score is not null")
    if kind == "indicator":
        return rows.filter(F.lower(F.trim("v")).isin("y", "yes", "true", "t", "1")).select(id, F.col("n").alias("indicator"), F.lit("1").alias("value"))
    rows = rows.filter(meaningful(F.col("v")))
    if kind == "history":
        return rows.select(
            id, F.concat(F.lit("["), "c", F.lit("]")).alias("name"), F.concat(F.lit("["), "n", F.lit("]")).alias("source"),
            F.trim("v").alias("value"),
        )
    return rows.select(id, F.col("n").alias("name"), F.trim("v").alias("value"), *([F.col("c").alias("source_report_key")] if keyed else []))


def group_rows(df: DataFrame, id: str, groups: dict[int, dict[str, Column]], asks: list[str], shared: dict[str, Column] | None = None, defaults: dict[str, object] | None = None, amounts: list[str] | None = None) -> DataFrame:
    """A row for each group (type to fields) that has a value in one of the fields that `asks` names, or a positive amount.

    shared fields are the same in all rows of a document; defaults are set only after the test.
    """
    parts = F.array(*[F.struct(
        F.lit(t).alias("type"), *[c.alias(n) for n, c in fields.items()], *[c.alias(n) for n, c in (shared or {}).items()],
    ) for t, fields in groups.items()])
    rows = df.select(F.col(id), F.explode(parts).alias("_g")).select(id, "_g.*")
    tests = [nonblank(F.col(a)) for a in asks] + [F.coalesce(F.col(a).try_cast("double") > 0, F.lit(False)) for a in amounts or []]
    rows = rows.filter(functools.reduce(operator.or_, tests))
    return rows.withColumns({n: F.coalesce(F.col(n), F.lit(v)) for n, v in (defaults or {}).items()}) if defaults else rows


def slot_rows(df: DataFrame, id: str, slots: list[dict[str, Column]], asks: list[str], amount: str | None = None, defaults: dict[str, object] | None = None) -> DataFrame:
    """Numbered slots to rows with sort_order 1 to N; an amount of 0 alone makes no row, nor do fields not asked for."""
    parts = F.array(*[F.struct(F.lit(i).alias("sort_order"), *[c.alias(n) for n, c in s.items()]) for i, s in enumerate(slots, 1)])
    rows = df.select(F.col(id), F.explode(parts).alias("_s")).select(id, "_s.*")
    tests = [nonblank(F.col(a)) for a in asks]
    if amount:
        tests.append(F.coalesce(F.col(amount).try_cast("double") != 0, F.lit(False)))
    rows = rows.filter(functools.reduce(operator.or_, tests))
    return rows.withColumns({n: F.coalesce(F.col(n), F.lit(v)) for n, v in (defaults or {}).items()}) if defaults else rows
