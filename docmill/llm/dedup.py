"""Exact deduplication by Grace hash partitions."""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, stage

#: Bytes of distinct content that one open-addressing table holds (and one text more); a bucket with more is cut by further bits of the hash.
TABLE_BYTES = 48 << 20
#: What an entry of a table takes beside its content, counted with it, so that many short texts fill a table too.
ENTRY_BYTES = 200
#: Pairs that are handed on at once.
PAIRS = 1 << 16
FANOUT_BITS = 4
#: Content bytes that a map task gathers before it hands on its distinct texts.
LOCAL_BYTES = 16 << 20
HASH_BITS = 60
#: White space runs that count as one space.
SPACES = r"[\x20\x09-\x0D]+"


class Table:
    """Open addressing with linear probing; equal hashes are settled by comparing the complete content."""

    def __init__(self) -> None:
        self.slots = np.full(64, -1, np.int64)
        self.hashes: list[int] = []
        self.contents: list[bytes] = []

    def find(self, h: int, content: bytes) -> tuple[int, bool]:
        """The entry of a content, and whether it is new."""
        if 2 * len(self.hashes) >= len(self.slots):
            self._grow()
        slots, mask = self.slots, len(self.slots) - 1
        at = h & mask
        while (entry := slots[at]) >= 0:
            if self.hashes[entry] == h and self.contents[entry] == content:
                return int(entry), False
            at = (at + 1) & mask
        slots[at] = len(self.hashes)
        self.hashes.append(h)
        self.contents.append(content)
        return len(self.hashes) - 1, True

    def get(self, h: int, content: bytes) -> int:
        """The entry of a content, or -1."""
        slots, mask = self.slots, len(self.slots) - 1
        at = h & mask
        while (entry := slots[at]) >= 0:
            if self.hashes[entry] == h and self.contents[entry] == content:
                return int(entry)
            at = (at + 1) & mask
        return -1

    def _grow(self) -> None:
        self.slots = np.full(4 * len(self.slots), -1, np.int64)
        mask = len(self.slots) - 1
        for entry, h in enumerate(self.hashes):
            at = h & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = entry


def _local(batches: Iterator[pa.RecordBatch], rep: str, digest: str) -> Iterator[pa.RecordBatch]:
    """Rows (..., h, content, uid) to (..., uid, rep, digest): rep is the first row of this task's table with the same content.

    The table starts afresh at LOCAL_BYTES, so a task's memory is bounded; later stages join what it kept apart. A
    content is digested (SHA-256) once for each table.
    """
    table, reps, held = Table(), [], 0
    for batch in batches:
        uids, n = batch.column(batch.num_columns - 1), batch.num_columns
        out = []
        for uid, h, content in zip(uids.to_pylist(), batch.column(n - 3).to_pylist(), batch.column(n - 2), strict=True):
            data = content.as_buffer().to_pybytes()
            if held > LOCAL_BYTES:
                table, reps, held = Table(), [], 0
            entry, new = table.find(h, data)
            if new:
                reps.append((uid, hashlib.sha256(data).digest()))
                held += len(data) + ENTRY_BYTES
            out.append(reps[entry])
        columns = [*batch.columns[: n - 3], uids, pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.binary())]
        names = batch.schema.names
        yield pa.record_batch(columns, [*names[: n - 3], names[-1], rep, digest])


def _grace(rows: Iterator[tuple[int, int, bytes]], folder: str, shift: int, held: list, size: int) -> Iterator[list[tuple[int, int]]]:
    """(uid, rep uid) pairs of a bucket, in runs.

    Rows go into the table as they come, so copies of a text it holds take no room. Once it is full, texts that it
    lacks go to spill files by further bits of the hash, and each file is a bucket of its own.
    `held` has the rep of each entry of the table, `size` the bytes of their contents.
    """
    spills: list | None = None
    table, out = Table(), []
    for uid, h, content in rows:
        full = size >= TABLE_BYTES and shift + FANOUT_BITS <= HASH_BITS
        entry = table.get(h, content)
        if entry < 0 and full:
            spills = spills or [tempfile.TemporaryFile(dir=folder) for _ in range(1 << FANOUT_BITS)]
            pickle.dump((uid, h, content), spills[(h >> shift) & ((1 << FANOUT_BITS) - 1)], 5)
            continue
        if entry < 0:
            entry, _ = table.find(h, content)
            held.append(uid)
            size += len(content) + ENTRY_BYTES
        out.append((uid, held[entry]))
        if len(out) >= PAIRS:
            yield out
            out = []
    yield out
    del table, out
    held.clear()
    for f in spills or []:
        f.seek(0)
        yield from _grace(_unspill(f), folder, shift + FANOUT_BITS, [], 0)
        f.close()


def _unspill(f) -> Iterator[tuple[int, int, bytes]]:
    while True:
        try:
            yield pickle.load(f)
        except EOFError:
            return


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task of level 0, which the shuffle has made: its rows' groups by complete content."""

    def rows():
        for batch in batches:
            yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), (x.as_buffer().to_pybytes() for x in batch.column(2)), strict=True)

    # the files are unlinked at once and hold only what this task can make again
    with tempfile.TemporaryDirectory(dir=os.environ.get("TMPDIR")) as folder:
        for pairs in _grace(rows(), folder, 0, [], 0):
            if pairs:
                a = np.array(pairs, np.int64)
                yield pa.record_batch([pa.array(a[:, 0]), pa.array(a[:, 1])], ["rep", "root"])


def groups(docs: DataFrame, content: str = "text", key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(rows, groups): docs with a row number _uid, and for each _uid its group of equal texts.

    Texts are equal when identical after each white-space run has become one space; null counts as empty. A map task
    first folds its own copies, so that a group of any size is a few rows for each task when contents are shuffled;
    then level 0 of the Grace partitions is the shuffle by hash, further levels are spill files of the task.
    The row with the smallest key stays (of equal keys, that which was read first; a null key is larger than others).
    An empty table gives no rows. groups has _uid, id, digest (SHA-256), keep_id, keep_uid, group_size.
    """
    uid, rep, digest = fresh(docs, "_uid"), fresh(docs, "_rep"), fresh(docs, "_digest")
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def normal(c: str):
        return F.regexp_replace(F.coalesce(F.col(c), F.lit("")), SPACES, " ")

    def hashed(c):
        return F.shiftrightunsigned(F.xxhash64(c), 64 - HASH_BITS)

    wide = docs.select(
        "*", hashed(normal(content)).alias(fresh(docs, "_h")), F.encode(normal(content), "UTF-8").alias(fresh(docs, "_content")),
        F.monotonically_increasing_id().alias(uid),
    )
    rows = stage(wide.mapInArrow(lambda batches: _local(batches, rep, digest), f"{types}, `{uid}` long, `{rep}` long, `{digest}` binary"), "dedup-rows")
    member = rows.select(F.col(uid).alias("_uid"), F.col(rep).alias("rep"), F.col(key).alias("id"), F.lower(F.hex(digest)).alias("digest"))
    reps = rows.filter(F.col(uid) == F.col(rep)).select(F.col(rep).alias("rep"), normal(content).alias("text"))
    hashes = reps.select("rep", hashed("text").alias("h"), F.encode("text", "UTF-8").alias("content"))
    roots = stage(hashes.repartition("h").mapInArrow(_buckets, "rep long, root long"), "dedup-roots")
    part = member.groupBy("rep").agg(F.min(F.struct(F.col("id").isNull().alias("no"), "id", "_uid")).alias("least"), F.count("*").alias("n"))
    whole = roots.join(part, "rep").groupBy("root").agg(F.min("least").alias("least"), F.sum("n").alias("group_size"))
    found = roots.join(whole, "root").select("rep", F.col("least.id").alias("keep_id"), F.col("least._uid").alias("keep_uid"), "group_size")
    # a rep stands for rows of one task only, so this join has no key with a large share of all rows
    return rows, member.join(found, "rep").drop("rep")


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row of each group of equal texts, with the columns of docs as they were."""
    rows, found = groups(docs)
    uid = rows.columns[len(docs.columns)]
    stays = found.filter("_uid = keep_uid").select(F.col("_uid").alias(uid))
    return rows.join(stays, uid, "left_semi").select(*docs.columns)


def op2_grace_dedup(spark, sf_dir: str) -> DataFrame:
    """Groups of equal texts among all documents, dropped rows too."""
    _, found = groups(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", (F.col("_uid") == F.col("keep_uid")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


OP2_SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM n WINDOW g AS (PARTITION BY t)
"""
