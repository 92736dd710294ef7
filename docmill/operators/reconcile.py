"""Audits between source documents, what mapping makes of them, and what is stored. Each is a few joins of whole tables."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import nonblank
from ..sources.staging import spread
from .sinks import absent


def gap(source: DataFrame, log: DataFrame, scores: DataFrame, id: str) -> DataFrame:
    """One row: source and log totals, documents without a log row, and those logged with and without scores."""
    logged = log.select(id).distinct().withColumn("_l", F.lit(True))
    scored = scores.select(id).distinct().withColumn("_s", F.lit(True))
    both = source.select(id).join(logged, id, "left").join(scored, id, "left")
    n, done = F.count("*"), F.count("_l")
    return both.agg(
        n.alias("source_rows"), done.alias("logged"), (n - done).alias("gap"), F.round(F.try_divide(100.0 * (n - done), n), 2).alias("gap_pct"),
        F.min(F.when(F.col("_l").isNull(), F.col(id))).alias("gap_min"), F.max(F.when(F.col("_l").isNull(), F.col(id))).alias("gap_max"),
        F.count_if(F.col("_l") & F.col("_s")).alias("with_scores"), F.count_if(F.col("_l") & F.col("_s").isNull()).alias("without_scores"),
    )


def suspects(table: DataFrame, id: str, markers: dict[str, list[object]], source: DataFrame) -> DataFrame:
    """Ids with a fallback marker, and which columns have one; only ids of the source."""
    items = F.array_compact(F.array(*[F.when(F.col(c).cast("string").isin([str(v) for v in vs]), F.lit(c)) for c, vs in markers.items()]))
    return table.select(id, F.array_join(items, ",").alias("reason")).filter("reason <> ''").join(source.select(id), id, "left_semi")


def suspects_over(tables: dict[str, tuple[DataFrame, dict[str, list[object]]]], id: str, source: DataFrame) -> DataFrame:
    """Ids of the source that have a fallback marker in any of several tables: (id, n, reasons as table.column, in order).

    Each table is read once, whatever the number of its markers, and only ids and reasons are shuffled, once.
    """
    parts = []
    for name, (df, markers) in tables.items():
        items = [F.when(F.col(c).cast("string").isin([str(v) for v in vs]), F.lit(f"{name}.{c}")) for c, vs in markers.items()]
        parts.append(df.select(F.col(id), F.explode(F.array_compact(F.array(*items))).alias("reason")))
    marked = functools.reduce(DataFrame.unionByName, parts).groupBy(id).agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_set("reason")), ",").alias("reasons"))  # as many as markers
    return marked.join(source.select(id).distinct(), id, "left_semi")


def verify_smells(stored: DataFrame, source: DataFrame, id: str, rules: dict[str, tuple[str, object]]) -> DataFrame:
    """For each stored marker: 'injected' where the source is blank, 'mapping failure' where it has a value.

    rules: stored column to (source column, marker).
    """
    both = stored.join(source, id)
    items = F.array_compact(F.array(*[F.when(
        F.col(c).cast("string") == str(marker),
        F.struct(F.lit(c).alias("field"), F.when(nonblank(F.col(s)), "mapping failure").otherwise("injected").alias("verdict")),
    ) for c, (s, marker) in rules.items()]))
    return both.select(id, F.explode(items).alias("_x")).select(id, "_x.*")


def doc_verdict(source: DataFrame, tables: dict[str, DataFrame], id: str, filled: Column, mismatch: Column) -> DataFrame:
    """PASS, WARN or FAIL: the source must be there; a missing table, sparse rows and mismatches warn."""
    out = source
    for name, df in tables.items():
        out = out.join(df.select(id).distinct().withColumn(f"_{name}", F.lit(True)), id, "left")
    missing = functools.reduce(lambda a, b: a | b, [F.col(f"_{n}").isNull() for n in tables])
    return out.select(id, F.when(~F.col("has_source"), "FAIL").when(missing | (filled < 0.15) | mismatch, "WARN").otherwise("PASS").alias("verdict"))


def verify_enum(both: DataFrame, id: str, source: str, stored: str, expected: Column) -> DataFrame:
    s, d = nonblank(F.col(source)), F.col(stored)
    out = F.when(~s & d.isNull(), "both empty").when(~s, "stored without source").when(expected.isNull(), "unknown code").when(d.isNull(), "not stored")
    return both.select(id, out.when(d == expected, "match").otherwise("mismatch").alias("outcome"))


def audit_enums(df: DataFrame, known: dict[str, list[str]]) -> DataFrame:
    """Per column: rows, nulls, values outside the list, and EMPTY, NEVER POPULATED, SPARSE or OK."""
    parts = [F.struct(
        F.lit(c).alias("column_name"), F.count("*").alias("n_rows"), F.count_if(F.col(c).isNull()).alias("n_null"),
        F.count_if(~F.col(c).isin(v)).alias("n_unknown"),
    ) for c, v in known.items()]
    rows = df.agg(F.array(*parts).alias("_a")).select(F.explode("_a").alias("_x")).select("_x.*")
    state = F.when(F.col("n_rows") == 0, "EMPTY").when(F.col("n_null") == F.col("n_rows"), "NEVER POPULATED").when(F.col("n_null") > 0.95 * F.col("n_rows"), "SPARSE").otherwise("OK")
    return rows.withColumn("state", state)


def source_first(expected: DataFrame, actual: DataFrame, log: DataFrame, keys: list[str], value: str) -> DataFrame:
    """One row: coverage (documents processed), completeness (expected rows stored), accuracy (stored rows right), in percent."""
    id = keys[0]
    done = log.select(id).distinct().withColumn("_l", F.lit(True))
    stored = actual.select(*keys, F.col(value).alias("_v")).withColumn("_a", F.lit(True))
    both = expected.join(done, id, "left").join(stored, keys, "left")
    n, seen, there = F.count("*"), F.count("_l"), F.count_if(F.col("_l") & F.col("_a"))
    right = F.count_if(F.col("_l") & F.col("_a") & F.col("_v").eqNullSafe(F.col(value)))
    return both.agg(
        n.alias("expected"), F.round(F.try_divide(100.0 * seen, n), 2).alias("coverage"),
        F.round(F.try_divide(100.0 * there, seen), 2).alias("completeness"),
        F.round(F.try_divide(100.0 * right, there), 2).alias("accuracy"),
    )


def source_first_counts(expected: DataFrame, actual: DataFrame, id: str) -> DataFrame:
    """Documents whose stored number of rows isn't the expected one."""
    a = expected.groupBy(id).agg(F.count("*").alias("n_expected"))
    b = actual.groupBy(id).agg(F.count("*").alias("n_stored"))
    return a.join(b, id, "left").select(id, "n_expected", F.coalesce("n_stored", F.lit(0)).alias("n_stored")).filter("n_expected <> n_stored")


def _sides(sides: dict[str, tuple[DataFrame, list[str]]], keys: list[str]) -> DataFrame:
    """A row for each key of any side (null is a key), with each side's columns, and whether it has the key: one shuffle, whatever their number.

    Of several rows with one key in a side, each column has its largest value.
    """
    parts = [df.select(*keys, *cols, F.lit(True).alias(f"_{name}")) for name, (df, cols) in sides.items()]
    every = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return spread(every, *keys).groupBy(*keys).agg(*[F.max(c).alias(c) for c in every.columns if c not in keys])


def reconcile(mapped: DataFrame, stored: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Every key of either side (null is a key): PASS, FAIL (differs or missing) or WARN (stored beyond what mapping gives)."""
    a = mapped.select(*keys, F.col(value).alias("mapped")).withColumn("_m", F.lit(True)).alias("a")
    b = stored.select(*keys, F.col(value).alias("stored")).withColumn("_s", F.lit(True)).alias("b")
    out = F.when(F.col("_m").isNull(), "WARN extra").when(F.col("_s").isNull(), "FAIL missing").when(F.col("mapped").eqNullSafe(F.col("stored")), "PASS").otherwise("FAIL differs")
    on = functools.reduce(lambda x, y: x & y, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    key = [F.when(F.col("_m"), F.col(f"a.{k}")).otherwise(F.col(f"b.{k}")).alias(k) for k in keys]
    return a.join(b, on, "full").select(*key, "mapped", "stored", out.alias("outcome"))


def reconcile_source(source: DataFrame, mapped: DataFrame, stored: DataFrame, keys: list[str], zero_suffix: str = "_score") -> DataFrame:
    """Source, mapped and stored key-value rows, side by side: (keys, attribute, expected, mapped, stored, outcome, cause, smell).

    source has attribute, raw (its text) and expected (what should be stored, or null); mapped and stored have value.
    PASS: the stored value is the expected one (cause 'not mapped' if mapping didn't make it, so something else did), or
    there was nothing to store. FAIL: 'differs', 'not stored', or 'not mapped', which is why it isn't stored. WARN: a value
    that gives no row, or rows beyond the source, stored ('extra') or only mapped ('mapped without source').
    smell: a zero that was kept for an attribute whose name ends in a suffix, or a mapped value that the source doesn't give.
    """
    one = _sides({
        "source": (source, ["attribute", "raw", "expected"]), "m": (mapped.withColumn("mapped", F.col("value").cast("string")), ["mapped"]),
        "s": (stored.withColumn("stored", F.col("value").cast("string")), ["stored"]),
    }, keys)
    wants, has_m, has_s = F.col("expected").isNotNull(), F.col("_m").isNotNull(), F.col("_s").isNotNull()
    made, kept = F.coalesce(F.col("mapped") == F.col("expected"), F.lit(False)), F.coalesce(F.col("stored") == F.col("expected"), F.lit(False))

    def verdict(outcome: str, cause: str | None) -> Column:
        return F.struct(F.lit(outcome).alias("outcome"), F.lit(cause).cast("string").alias("cause"))

    both = (
        F.when(wants & kept & made, verdict("PASS", None)).when(wants & kept, verdict("PASS", "not mapped")).when(wants & has_s, verdict("FAIL", "differs"))
        .when(wants & made, verdict("FAIL", "not stored")).when(wants, verdict("FAIL", "not mapped")).when(has_s, verdict("WARN", "extra")).when(has_m, verdict("WARN", "mapped without source"))
        .when(nonblank(F.col("raw")), verdict("WARN", "value gives no row")).otherwise(verdict("PASS", "nothing to store"))
    )
    zero = F.lower("attribute").endswith(zero_suffix) & (F.col("expected").try_cast("double") == 0)
    smell = F.when(zero, "zero score").when(wants & has_m & ~made, "mapped value differs")
    return one.withColumn("_o", both).select(*keys, "attribute", "expected", "mapped", "stored", "_o.outcome", "_o.cause", smell.alias("smell"))


def outcome_counts(found: DataFrame, by: list[str]) -> DataFrame:
    """Outcomes, causes and smells with their numbers, and the smallest and largest document, by some columns."""
    id = found.columns[0]
    return found.groupBy(*by, "outcome", "cause", "smell").agg(F.count("*").alias("n"), F.min(id).alias("first_id"), F.max(id).alias("last_id"))


def missing_rows(expected: DataFrame, stored: DataFrame, log: DataFrame, keys: list[str]) -> DataFrame:
    """Expected rows of successful documents that aren't stored; null keys are equal."""
    ok = log.filter("status = 'success'").select(keys[0])
    return absent(expected.join(ok, keys[0], "left_semi"), stored, keys)


def collision_winner(source: DataFrame, stored: DataFrame, key: str, doc: str) -> DataFrame:
    """Shared keys: the document that owns the stored row, and each that lost it."""
    owner = stored.select(key, F.col(doc).alias("owner"))
    pairs = source.select(key, F.col(doc).alias("loser")).distinct().join(owner, key)
    return pairs.filter("loser <> owner")


def log_consistency(base: DataFrame, log: DataFrame, id: str) -> DataFrame:
    """One row: base rows, success rows, and base rows without any log row."""
    ok = log.filter("status = 'success'").agg(F.count("*").alias("n_success"))
    seen = log.select(id).distinct().withColumn("_l", F.lit(True))
    return base.join(seen, id, "left").agg(F.count("*").alias("n_base"), F.count_if(F.col("_l").isNull()).alias("n_unlogged")).crossJoin(F.broadcast(ok))


def verify_calc(df: DataFrame, stored: str, again: Column) -> DataFrame:
    same = F.col(stored).eqNullSafe(again)
    return df.agg(F.count_if(same).alias("passed"), F.count_if(~same).alias("failed"))
