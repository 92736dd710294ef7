"""Tables in buckets of their key: a change reads and rewrites the buckets that it touches, and leaves the other files as they are."""

from __future__ import annotations

import functools
import operator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import staged
from .pick import settle
from .sinks import absent, exists, upsert

BUCKET = "_bucket"


@dataclass
class Bucketed:
    """A table under a path whose rows lie in folders by a hash of their key (null keys have a bucket, too).

    A change of few keys costs as much as their buckets, so there should be as many buckets as make one a file or a few. The
    number is the table's for good. Files of a bucket are split where it is large, so a hot key is no single task's work.
    A bucket is replaced when all of its new files are written; what a failed job has written is never seen.
    """

    spark: SparkSession
    path: str
    keys: list[str]
    buckets: int = 256

    def change(self, df: DataFrame) -> DataFrame:
        """The rows of a change, with their buckets. They are staged, as they are read once for their buckets and once for their rows."""
        return staged(self.of(df), "bucket-change")

    def of(self, df: DataFrame) -> DataFrame:
        """df with each row's bucket."""
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def write(self, df: DataFrame, mode: str) -> None:
        """Rows that have a bucket, a file for each bucket, or several for a large one."""
        df.hint("rebalance", BUCKET).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path)

    def create(self, df: DataFrame) -> Bucketed:
        if exists(self.spark, self.path):
            raise ValueError(f"{self.path} exists")
        # without rows there would be no folder and no schema
        df.limit(0).write.parquet(f"{self.path}/{BUCKET}=-1")
        self.write(self.of(df), "append")
        return self

    def rows(self, only: list[int] | None = None) -> DataFrame:
        """The table's rows, with their bucket; with `only`, no other folder is read."""
        df = self.spark.read.option("basePath", self.path).parquet(self.path)
        return df if only is None else df.filter(F.col(BUCKET).isin(only))

    def read(self) -> DataFrame:
        return self.rows().drop(BUCKET)

    def touched(self, df: DataFrame) -> list[int]:
        """The buckets of some rows: as many numbers as there are buckets, at most."""
        return sorted(r[0] for r in df.select(BUCKET).distinct().collect())

    def upsert(self, new: DataFrame, values: list[str], pos: str | None = None) -> list[int]:
        """Set the values that new rows have, and add rows with new keys; returns the buckets that were rewritten. See sinks.upsert()."""
        marked = self.change(new)
        only = self.touched(marked)
        if only:
            state = self.rows(only)
            rest = [c for c in state.columns if c not in (*self.keys, *values, BUCKET)]
            if rest:
                raise ValueError(f"columns {rest} are neither keys nor values")
            self.write(self.of(upsert(marked, state, self.keys, values, pos)), "overwrite")
        return only

    def insert_absent(self, new: DataFrame, *order: str | Column) -> list[int]:
        """Add the rows whose key isn't there, of several with one key the first in `order`; existing files stay. The first writer wins."""
        marked = self.change(settle(new, self.keys, *order))
        only = self.touched(marked)
        if only:
            self.write(absent(marked, self.rows(only).select(*self.keys), self.keys), "append")
        return only

    def missing(self, expected: DataFrame) -> DataFrame:
        """Expected rows whose key isn't there, each key once, with their bucket: what a backfill would add."""
        marked = self.change(settle(expected, self.keys))
        only = self.touched(marked)
        return absent(marked, self.rows(only).select(*self.keys), self.keys)

    def backfill(self, expected: DataFrame, apply: bool) -> DataFrame:
        """How many rows are missing, and the smallest and largest first key of theirs; with apply they are added, and no file is rewritten."""
        lost = self.missing(expected)
        key = self.keys[0]
        if not apply:
            return lost.agg(F.count("*").alias("would_insert"), F.min(key).alias("first_id"), F.max(key).alias("last_id"))
        lost = staged(lost, "bucket-missing")
        self.write(lost, "append")
        return lost.agg(F.count("*").alias("inserted"))

    def delete(self, gone: DataFrame) -> list[int]:
        """Remove the rows with some keys; returns the buckets that were rewritten. Empty buckets lose their folders."""
        marked = self.change(gone.select(*self.keys).distinct())
        only = self.touched(marked)
        if not only:
            return []
        state = self.rows(only)
        hit = self.touched(state.join(marked.select(*self.keys), _same(state, marked, self.keys), "left_semi"))  # others stay as they are
        if not hit:
            return []
        left = absent(self.rows(hit), marked.select(*self.keys), self.keys)
        full = self.touched(left)
        self.write(left, "overwrite")
        for bucket in set(hit) - set(full):
            at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{BUCKET}={bucket}")
            at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)
        return hit


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    return functools.reduce(operator.and_, [a[k].eqNullSafe(b[k]) for k in keys])


def delete_ids(tables: dict[str, Bucketed], ids: DataFrame, id: str, through: dict[str, tuple[str, str]]) -> dict[str, list[int]]:
    """Remove documents from all tables; children (name to parent table and key) go with their parents, and first. Returns the rewritten buckets.

    A table whose key isn't the id is searched for the keys that go with it, which reads its keys and ids, no more.
    """
    gone = {}
    for name, table in tables.items():
        parent, key = through.get(name, (name, None))
        have = tables[parent].read().join(ids.select(id), id, "left_semi")
        gone[name] = have.select(F.col(key).alias(table.keys[0])) if key else have.select(*table.keys)
    order = sorted(tables, key=lambda n: n not in through)
    return {name: tables[name].delete(gone[name]) for name in order}
