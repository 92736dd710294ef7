"""Writing mapped tables so that a document is seen in all of them or in none."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import dealt
from .pick import keep_last, settle

#: The column that says which run has written a row.
RUN = "_run_id"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a table or file at a path of any store that Spark knows."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def union_columns(*frames: DataFrame) -> DataFrame:
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def absent(new: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """New rows whose key isn't stored; null keys are equal."""
    a, b = new.alias("a"), stored.select(*keys).alias("b")
    on = functools.reduce(lambda x, y: x & y, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    return a.join(b, on, "left_anti")


def insert_absent(new: DataFrame, stored: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The stored rows, and new ones whose key isn't stored: the first writer wins, of new rows with one key the first in `order` (see settle())."""
    return union_columns(stored, absent(settle(new, keys, *order), stored, keys))


def upsert(new: DataFrame, stored: DataFrame, keys: list[str], values: list[str], pos: str | None = None) -> DataFrame:
    """The state after an upsert: null-safe keys; only values that a new row has are set; of new rows with one key the last counts.

    Without `pos` new rows with one key have no order, so each value is the largest of theirs.
    """
    last = keep_last(new, keys, pos).drop(pos) if pos else new.groupBy(*keys).agg(*[F.max(v).alias(v) for v in values])
    a, b = stored.alias("a"), last.alias("b")
    on = functools.reduce(lambda x, y: x & y, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    both = a.withColumn("_a", F.lit(True)).alias("a").join(b.withColumn("_b", F.lit(True)).alias("b"), on, "full")
    key = [F.when(F.col("a._a"), F.col(f"a.{k}")).otherwise(F.col(f"b.{k}")).alias(k) for k in keys]
    return both.select(*key, *[F.coalesce(f"b.{v}", f"a.{v}").alias(v) for v in values])


def backfill(expected: DataFrame, stored: DataFrame, keys: list[str], apply: bool) -> DataFrame:
    """Missing rows only, each key once: the new state, or (a dry run) how many would be inserted."""
    missing = absent(settle(expected, keys), stored, keys)
    return stored.unionByName(missing) if apply else missing.agg(F.count("*").alias("would_insert"), F.min(keys[0]).alias("first_id"))


def write_tables(frames: dict[str, DataFrame], order: list[str], path: str) -> list[str]:
    """Append each table under path, parents before children, tables that the order lacks last; returns their order."""
    names = [n for n in order if n in frames] + sorted(set(frames) - set(order))
    for n in names:
        frames[n].write.mode("append").parquet(f"{path}/{n}")
    return names


def commit_documents(frames: dict[str, DataFrame], failed: DataFrame, log: DataFrame, order: list[str], path: str, id: str = "doc_id", run: str | None = None) -> str:
    """Write the rows of documents that didn't fail in any table, and the log last; all carry the run's id, which is returned.

    A run that ends early leaves no log rows, so its rows are never seen, also if another run commits the same documents.
    """
    run = run or uuid.uuid4().hex
    bad = failed.select(id).distinct()
    write_tables({n: df.join(dealt(bad), id, "left_anti").withColumn(RUN, F.lit(run)) for n, df in frames.items()}, order, path)
    log.withColumn(RUN, F.lit(run)).write.mode("append").parquet(f"{path}/processing_log")
    return run


def failures(findings: DataFrame, stage: str = "mapping") -> DataFrame:
    """(doc_id, stage, message) of documents with critical findings, as commit_documents() takes them: a row each, with its first finding."""
    critical = findings.filter("severity = 'critical'")
    first = critical.groupBy("doc_id").agg(F.min(F.struct("table_name", "field", "message")).alias("f"))
    return first.select("doc_id", F.lit(stage).alias("stage"), F.concat("f.table_name", F.lit("."), "f.field", F.lit(": "), "f.message").alias("message"))


def visible(spark: SparkSession, path: str, table: str, id: str = "doc_id") -> DataFrame:
    """A table's rows of committed documents, as the run that logged their success has written them (of several, one)."""
    log = spark.read.parquet(f"{path}/processing_log").filter("status = 'success'")
    done = log.groupBy(F.col("app_id").alias(id)).agg(F.min(RUN).alias(RUN))
    return spark.read.parquet(f"{path}/{table}").join(dealt(done), [id, RUN], "left_semi").drop(RUN)


def log_outcomes(ok: DataFrame, failed: DataFrame, session: str, id: str = "doc_id") -> DataFrame:
    """A row for each document; failures with 'stage: message', cut to 500 characters."""
    good = ok.select(F.col(id).alias("app_id"), F.lit("success").alias("status"), F.lit(None).cast("string").alias("failure_reason"))
    bad = failed.select(
        F.col(id).alias("app_id"), F.lit("failed").alias("status"),
        F.substring(F.concat("stage", F.lit(": "), "message"), 1, 500).alias("failure_reason"),
    )
    return good.unionByName(bad).withColumn("session_id", F.lit(session))


def reclassify(failed: DataFrame, stored: DataFrame, id: str) -> DataFrame:
    """Failures whose base row is stored were successes of an earlier run."""
    there = stored.select(id).distinct().withColumn("_there", F.lit(True))
    return failed.join(there, id, "left").withColumn("status", F.when(F.col("_there"), "success").otherwise("failed")).drop("_there")


def delete_ids(tables: dict[str, DataFrame], ids: DataFrame, id: str, through: dict[str, tuple[str, str]]) -> dict[str, DataFrame]:
    """The tables without some documents; children (name to parent table and key) go with their parents."""
    out = {}
    for name, df in tables.items():
        if name in through:
            parent, key = through[name]
            gone = tables[parent].join(ids.select(id), id, "left_semi").select(key).distinct()
            out[name] = df.join(gone, key, "left_anti")
        else:
            out[name] = df.join(ids.select(id), id, "left_anti")
    return out


def export_failures(log: DataFrame, path: str) -> None:
    """Failures as CSV in parts, and as JSON by stage (a folder for each, so no stage is gathered in one place)."""
    failed = log.filter("status = 'failed'").withColumn("stage", F.trim(F.substring_index("failure_reason", ":", 1)))
    failed.write.mode("overwrite").option("header", True).csv(f"{path}/csv")
    failed.write.mode("overwrite").partitionBy("stage").json(f"{path}/json")
