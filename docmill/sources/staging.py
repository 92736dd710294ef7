"""Tables staged in the folder that driver and executors share."""

from __future__ import annotations

import contextlib
import os
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []
#: Bytes of a table, by Spark's estimate, that one task sorts; its rows are some times larger in memory.
PART_BYTES = 8 << 20
UNKNOWN = 1 << 31  # no number of partitions: Spark takes rows of unknown size for larger than anything


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in spark.checkpoint.dir, or in a folder of our own where that is unset and all run here (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[.*\])?$", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _own:
            os.makedirs("/tmp/checkpoints", exist_ok=True)
            _own.append(tempfile.mkdtemp(dir="/tmp/checkpoints"))
        root = f"file://{_own[0]}"
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Written once, read by all that follows."""
    path = shared_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by keys into as many partitions as their size asks for, so none outgrows a task's memory and is spilled when tables grow.

    The size is that of the files that are read. Where it is unknown (rows of no file), or spark.sql.shuffle.partitions
    are enough, nothing is done, and Spark shuffles when it has to.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    n = -(-sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())) // PART_BYTES)
    return df.repartition(n, *keys) if int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) < n < UNKNOWN else df


def dealt(df: DataFrame) -> DataFrame:
    """The side of a join that has a row for many a document: dealt by the key and hashed in each task, whatever its size.

    Files of ids are packed so well that Spark takes millions of them for small, and would gather them in the driver to broadcast them.
    """
    return df.hint("shuffle_hash")


@contextlib.contextmanager
def grouped_by_sort(spark: SparkSession) -> Iterator[None]:
    """Lists that are collected in here stream over one sort; by hash, Spark gives up at 128 groups and sorts partial and whole lists anew."""
    key = "spark.sql.execution.useObjectHashAggregateExec"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)
