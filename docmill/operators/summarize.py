"""Aggregations: profiles, run statistics and audits, each over the whole table in one or two passes."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.staging import staged


def long_form(one: DataFrame, names: list[str], value: str, key: str = "column_name") -> DataFrame:
    """A single row's columns as rows."""
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias(key), F.col(n).alias(value)) for n in names])).alias("_x")).select("_x.*")


def null_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    counted = df.agg(F.count("*").alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counted.select(
        "n_rows", F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null")) for c in cols])).alias("_x"),
    ).select("_x.column_name", "n_rows", "_x.n_null")


def pair_mismatch(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """How often one side of a pair is set and the other isn't."""
    names = [f"{a}_{b}" for a, b in pairs]
    one = df.agg(*[F.count_if(F.col(a).isNotNull() != F.col(b).isNotNull()).alias(n) for (a, b), n in zip(pairs, names, strict=True)])
    return long_form(one, names, "mismatches", "pair")


def value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    rows = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols])).alias("_x"))
    return rows.select("_x.*").groupBy("column_name", "value").agg(F.count("*").alias("n"))


def nonnull_histogram(df: DataFrame, cols: list[str]) -> DataFrame:
    filled = functools.reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in cols])
    return df.groupBy(filled.alias("n_filled")).agg(F.count("*").alias("n_rows"))


def population_pct(df: DataFrame, cols: list[str]) -> DataFrame:
    one = df.agg(*[F.round(F.try_divide(100 * F.count(c), F.count("*")), 1).alias(c) for c in cols])
    return long_form(one, cols, "pct")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row counts of several tables in one row."""
    rows = functools.reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("n")).withColumn("t", F.lit(n)) for n, df in tables.items()])
    return rows.agg(*[F.max(F.when(F.col("t") == n, F.col("n"))).alias(n) for n in tables])


def issue_counts(df: DataFrame, issues: dict[str, Column]) -> DataFrame:
    return df.agg(*[F.count_if(test).alias(n) for n, test in issues.items()])


def session_rollup(log: DataFrame) -> DataFrame:
    return log.groupBy("session_id").agg(
        F.count("*").alias("n"), F.min("app_id").alias("min_id"), F.max("app_id").alias("max_id"),
        F.count_if(F.col("status") == "success").alias("ok"), F.count_if(F.col("status") == "failed").alias("failed"),
    )


def distinct_counts(df: DataFrame, id: str, by: str) -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias("n"), F.countDistinct(id).alias("n_ids"))


def success_rate(log: DataFrame) -> DataFrame:
    ok = F.count_if(F.col("status") == "success")
    return log.agg(
        F.count("*").alias("processed"), ok.alias("ok"), F.count_if(F.col("status") == "failed").alias("failed"),
        F.round(F.try_divide(100.0 * ok, F.count("*")), 2).alias("pct"),
    )


def failures_by_stage(log: DataFrame, examples: int = 20) -> DataFrame:
    """Failures per stage with their share and rank, and the smallest ids as examples."""
    failed = log.filter("status = 'failed'").withColumn("stage", F.trim(F.substring_index("failure_reason", ":", 1)))
    # the smallest ids of each slice of a stage, then of the stage: a stage with most rows is no single task's work
    slice_ = F.pmod(F.xxhash64("app_id"), F.lit(64))
    first = failed.withColumn("_k", F.row_number().over(Window.partitionBy("stage", slice_).orderBy("app_id"))).filter(F.col("_k") <= examples)
    top = first.withColumn("_k", F.row_number().over(Window.partitionBy("stage").orderBy("app_id"))).filter(F.col("_k") <= examples)
    shown = top.groupBy("stage").agg(F.array_join(F.array_sort(F.collect_list("app_id")), ",").alias("examples"))
    by = failed.groupBy("stage").agg(F.count("*").alias("n")).join(shown, "stage")
    everything = Window.partitionBy()  # a row for each stage
    return by.select(
        "stage", "n", F.round(100.0 * F.col("n") / F.sum("n").over(everything), 2).alias("pct"),
        F.rank().over(Window.orderBy(F.desc("n"))).alias("rank"), "examples",
    )


def run_rollup(metrics: DataFrame) -> DataFrame:
    """Sums over instances, the longest duration, and documents per minute."""
    return metrics.agg(
        F.sum("processed").alias("processed"), F.sum("successful").alias("successful"), F.max("seconds").alias("seconds"),
        F.round(F.try_divide(F.sum("processed") * 60.0, F.max("seconds")), 4).alias("per_minute"),
    )


#: How fine the sketch is that brackets a median: its ranks are off by at most a group's rows over this.
ACCURACY = 10_000


def brackets(df: DataFrame, by: list[str], value: str, accuracy: int = ACCURACY, **more: Column) -> DataFrame:
    """(_k, _n, _lo, _hi, more): each group's number of values, and two values around its middle, from one mergeable sketch."""
    share, v = 4 / accuracy, F.col(value).cast("double")
    ends = F.array(F.min(v), F.max(v)) if share >= 0.5 else F.percentile_approx(v, F.array(F.lit(0.5 - share), F.lit(0.5 + share)), F.lit(accuracy))
    one = df.groupBy(F.struct(*by).alias("_k")).agg(F.count(value).alias("_n"), ends.alias("_e"), *[c.alias(n) for n, c in more.items()])
    return one.select("_k", "_n", F.get("_e", F.lit(0)).alias("_lo"), F.get("_e", F.lit(1)).alias("_hi"), *more)


def middle_values(df: DataFrame, by: list[str], value: str, ends: DataFrame) -> DataFrame:
    """(_k, _n, _v, _c): the distinct values inside of each group's bracket, and how often each occurs; all smaller ones are one row, with a null.

    How values are spread doesn't matter: a bracket has a thousandth of a group's rows, or values that fill it.
    """
    rows = df.filter(F.col(value).isNotNull()).select(F.struct(*by).alias("_k"), F.col(value).cast("double").alias("_v")).join(ends.select("_k", "_n", "_lo", "_hi"), "_k")
    return rows.filter("_v <= _hi").groupBy("_k", "_n", F.expr("if(_v >= _lo, _v, null)").alias("_v")).agg(F.count("*").alias("_c"))


def _with_medians(df: DataFrame, by: list[str], value: str, accuracy: int, **more: Column) -> DataFrame:
    ends = brackets(df, by, value, accuracy, **more)
    order = Window.partitionBy("_k").orderBy(F.col("_v").asc_nulls_first())
    placed = middle_values(df, by, value, ends).withColumn("_before", F.sum("_c").over(order) - F.col("_c"))

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_c")), F.col("_v")))

    two = placed.groupBy("_k").agg(at(F.floor((F.col("_n") - 1) / 2)).alias("_a"), at(F.floor(F.col("_n") / 2)).alias("_b"))
    found = F.col("_a") + (F.col("_b") - F.col("_a")) * 0.5
    median = F.when((F.col("_n") > 0) & found.isNull(), F.raise_error("the sketch missed a median")).otherwise(found)
    return ends.join(two, "_k", "left").select("_k.*", "_n", *more, median.alias("median"))


def medians(df: DataFrame, by: list[str], value: str, accuracy: int = ACCURACY) -> DataFrame:
    """The exact median of each group, without a group in one task or buffer.

    A sketch brackets the middle, and only the values in the bracket are counted and ordered. A group may have null keys; null
    values don't count. The input is read twice, so it should be a table.
    """
    return _with_medians(df, by, value, accuracy).filter("_n > 0").drop("_n")


def stage_stats(times: DataFrame, by: list[str], value: str) -> DataFrame:
    """Count, mean, median, spread and its class of stage times. All but the median come with its sketch, from one pass."""
    mean, sd = F.avg(value), F.stddev_samp(value)
    spread = F.when(F.try_divide(sd, mean) < 0.1, "stable").when(F.try_divide(sd, mean) < 0.5, "varied").otherwise("erratic")
    all_ = _with_medians(times, by, value, ACCURACY, n=F.count(value), mean=F.round(mean, 4), sd=F.round(sd, 4), spread=spread)
    return all_.select(*by, "n", "mean", F.round("median", 4).alias("median"), "sd", "spread")


def chunk_trend(chunks: DataFrame, by: str, order: str, value: str) -> DataFrame:
    """Mean, least and most of a run's chunks, and how far the last third lies from the first, in percent."""
    place = chunks.withColumn("_third", F.ntile(3).over(Window.partitionBy(by).orderBy(order)))
    first, last = (F.avg(F.when(F.col("_third") == k, F.col(value))) for k in (1, 3))
    return place.groupBy(by).agg(
        F.round(F.avg(value), 6).alias("mean"), F.min(value).alias("least"), F.max(value).alias("most"),
        F.round(F.try_divide(100 * (last - first), first), 6).alias("change_pct"),
    )


def efficiency(results: DataFrame, by: str, item: str, wall: str, workers: int) -> DataFrame:
    """The share of worker time that items took."""
    return results.groupBy(by).agg(F.round(F.try_divide(F.sum(item), workers * F.max(wall)), 6).alias("efficiency"))


def key_collisions(df: DataFrame, key: str, doc: str, examples: int = 10) -> DataFrame:
    """Keys of more than one document: how many, the smallest, and the largest. Lists would grow with a hot key."""
    return df.groupBy(key).agg(F.countDistinct(doc).alias("n_docs"), F.min(doc).alias("first_doc"), F.max(doc).alias("last_doc")).filter("n_docs > 1")


def collision_documents(df: DataFrame, key: str, doc: str) -> DataFrame:
    """(key, n_docs, doc, nth): every document of each key that more than one has, in order of the documents. Null keys are none.

    A row for each document, never a list. Pairs are dealt in ranges, so a key that most documents share is many tasks'
    work: a document's place is its place in its range, after those of the ranges before.
    """
    pairs = df.filter(F.col(key).isNotNull()).select(F.col(key), F.col(doc)).distinct()
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = staged(pairs.repartitionByRange(n, key, doc).withColumn("_range", F.spark_partition_id()), "collisions")
    parts = ranged.groupBy(key, "_range").agg(F.count("*").alias("_c"))  # a key's ranges, n at most
    whole = Window.partitionBy(key)
    sizes = parts.select(key, "_range", F.sum("_c").over(whole).alias("n_docs"), (F.sum("_c").over(whole.orderBy("_range")) - F.col("_c")).alias("_before")).filter("n_docs > 1")
    place = F.row_number().over(Window.partitionBy(key, "_range").orderBy(doc))
    return ranged.join(sizes, [key, "_range"]).withColumn("nth", F.col("_before") + place).select(key, "n_docs", doc, "nth")


def never_populated(tables: dict[str, DataFrame]) -> DataFrame:
    """Columns that are null in every row, over many tables: one aggregation for each."""
    parts = [long_form(df.agg(*[F.count(c).alias(c) for c in df.columns]), df.columns, "n").withColumn("table_name", F.lit(n)) for n, df in tables.items()]
    return functools.reduce(DataFrame.unionByName, parts).filter("n = 0").select("table_name", "column_name")


def default_counts(df: DataFrame, id: str, markers: dict[str, object], examples: int = 5) -> DataFrame:
    """Rows that equal a column's known default, and the smallest ids of such rows."""
    parts = []
    for c, v in markers.items():
        hit = df.filter(F.col(c) == F.lit(v))
        top = hit.select(id).orderBy(id).limit(examples).agg(F.array_join(F.array_sort(F.collect_list(F.col(id).cast("string"))), ",").alias("examples"))
        parts.append(hit.agg(F.count("*").alias("n")).crossJoin(top).withColumn("column_name", F.lit(c)))  # one row each
    return functools.reduce(DataFrame.unionByName, parts)
