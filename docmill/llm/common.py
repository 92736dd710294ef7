"""Shared helpers: staged tables, skew-proof joins, connected components, vocabulary pieces of work."""

from __future__ import annotations

import functools
import operator
import os
import re
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key with more than this share of all rows is hot; at most 1 / HOT_SHARE keys can be, so they may be broadcast.
HOT_SHARE = 0.002

_fallback: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a new one where that is unset and all run here (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.match(r"local(\[.*\])?$", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _fallback:
        os.makedirs("/tmp/checkpoints", exist_ok=True)
        _fallback.append(tempfile.mkdtemp(dir="/tmp/checkpoints"))
    return f"file://{_fallback[0]}"


def new_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_root(spark)}/docmill-{label}-{uuid.uuid4().hex}"
    _paths.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stage(df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """Write df to the shared folder and read it again: lineage ends here, and rows are the same at each later read."""
    path = new_path(df.sparkSession, label)
    df.write.option("compression", compression).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _staged[id(out)] = (weakref.ref(out, lambda _, key=id(out): _staged.pop(key, None)), path)
    return out


_staged: dict[int, tuple[weakref.ref, str]] = {}
#: Folders of staged tables, token files and archives, by application.
_paths: dict[str, list[str]] = {}


def release(spark: SparkSession) -> int:
    """Delete all tables, token files and archives that this application has staged, once its results are written or read; returns how many there were.

    A result is a plan over staged tables, so an operator can't delete the last of them itself.
    """
    paths = _paths.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return len(paths)


def shared_files(df: DataFrame) -> Callable[[int], Iterator[pa.RecordBatch]]:
    """What reads a staged table inside a task, from the shared folder, in batches of at most so many rows.

    So a table of any size can stream past what a task holds, without a broadcast.
    """
    path, names = re.sub("^file:/+", "file:///", _staged[id(df)][1]), df.columns

    def read(rows: int) -> Iterator[pa.RecordBatch]:
        from pyarrow import dataset, fs

        store, root = fs.FileSystem.from_uri(path)
        batches = dataset.dataset(root, filesystem=store, format="parquet").to_batches(columns=names, batch_size=rows, batch_readahead=1, fragment_readahead=1)
        yield from (b for b in batches if b.num_rows)

    return read


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more: neither a plan that is still to run, nor one that may run again."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(_staged.pop(id(df))[1])
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df hasn't got."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def all_of(conditions: list[Column]) -> Column:
    return functools.reduce(operator.and_, conditions)


def attach(left: DataFrame, right: DataFrame, key: str, count: str, total: int, how: str = "inner") -> DataFrame:
    """Join left to right, which has one row for each non-null key and, in `count`, the number of left's rows with it.

    Keys with over HOT_SHARE of the total (at most 1 / HOT_SHARE of them) are broadcast, so that left's rows of a
    hot key stay where they are; the others are joined by a shuffle.
    """
    bound = max(64, int(total * HOT_SHARE))
    own = [c for c in right.columns if c != key]
    hot = right.filter(F.col(count) > bound).select(key, F.struct(*own).alias("_hot"))  # one broadcast both marks rows and joins them
    marked = left.join(F.broadcast(hot), key, "left")
    few = marked.filter("_hot is not null").select(*[c for c in marked.columns if c != "_hot"], *[F.col("_hot")[c].alias(c) for c in own])
    rest = marked.filter("_hot is null").drop("_hot").join(right.filter(F.col(count) <= bound), key, how)
    return few.unionByName(rest)


def components(edges: DataFrame, label: str, rounds: int = 40) -> DataFrame:
    """Connected components of edges (a long, b long): (node, component), component being its smallest node.

    Large-star and small-star steps in turn (Kiveris et al., 2014), each of which is an aggregation and a join on
    staged tables; the number of rounds grows with the logarithm of a component's diameter. Self-loops are no edges; a node without others isn't returned.
    """

    def state(pairs: DataFrame):
        """n: how many pairs; open: whether they aren't stars yet, in which each u has one v, and no v is a u of another."""
        ends = pairs.select(F.explode(F.array(F.struct(F.col("u").alias("k"), F.lit(1).alias("up")), F.struct(F.col("v").alias("k"), F.lit(0).alias("up")))).alias("e"))
        nodes = ends.groupBy("e.k").agg(F.sum("e.up").alias("ups"), F.min("e.up").alias("least"))
        return nodes.agg(F.coalesce(F.sum("ups"), F.lit(0)).alias("n"), F.max((F.col("ups") > 1) | ((F.col("ups") > 0) & (F.col("least") == 0))).alias("open")).first()

    pairs = stage(edges.select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")).distinct(), f"{label}-edges")
    was = state(pairs)
    for _ in range(rounds):
        if not was.open:
            break
        large = stage(_star(pairs.select("u", "v").union(pairs.select(F.col("v"), F.col("u"))), True, 2 * was.n), f"{label}-large")
        small = stage(_star(large, False, was.n), f"{label}-star")
        discard(pairs, large)
        pairs, was = small, state(small)
    if was.open:
        raise RuntimeError(f"components: no end after {rounds} rounds")
    both = pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(pairs.select("v", "v"))
    return both.groupBy("node").agg(F.min("component").alias("component"))


def _star(pairs: DataFrame, larger: bool, total: int) -> DataFrame:
    """Link each neighbour of u (the larger ones, or the others) to the least of u and its neighbours.

    The large star gives at most a row for each pair, repeated ones too, as the small star after it takes them out.

    A hub's neighbours stay where they are, as its least one is broadcast. total: rows of pairs, at most.
    """
    near = pairs.filter("u <> v") if larger else pairs.filter("u > v")
    least = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("n"))
    linked = attach(near, least, "u", "n", total)
    if larger:
        return linked.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", "m")).distinct()
