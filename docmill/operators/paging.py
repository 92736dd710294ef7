"""Pages, samples, set operations and inline rows."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def with_total(df: DataFrame, like: DataFrame | None = None) -> DataFrame:
    """The number of all rows beside each. A one-row count is joined, so no window gathers the table in a task.

    `like` is a table with as many rows that costs less to count, such as df before columns were joined to it.
    """
    return df.crossJoin(F.broadcast((df if like is None else like).agg(F.count("*").alias("total"))))


def page(df: DataFrame, order: list[str | Column], offset: int, n: int) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(n)


def top_n(df: DataFrame, order: list[str | Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


#: A prime; ids are taken modulo it before they are multiplied, so no id overflows.
PRIME = 2**31 - 1


def sample_n(df: DataFrame, id: str, n: int, factor: int) -> DataFrame:
    """n rows in an order that a multiplier shuffles; the same ones each time."""
    return df.orderBy(F.pmod(F.pmod(F.col(id), F.lit(PRIME)) * (factor % PRIME), F.lit(PRIME)), id).limit(n)


def sample_seeded(df: DataFrame, id: str, n: int, seed: int = 0) -> DataFrame:
    """n rows in the order of a hash of seed and id: the same ones each time, others with another seed. Ids may be of any type and size."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit("")))), id).limit(n)


def distinct(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols).distinct()


def union_ids(*frames: DataFrame) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, frames).distinct()


def difference(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a that b lacks."""
    return a.join(b.select(*keys), keys, "left_anti")


def inline(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)
