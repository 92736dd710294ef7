"""Sum-of-squares packing of token pieces into sequences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stage
from .pieces import binary_rows, word_encoder
from .tokenfiles import vocabulary

#: Pieces of a packing group. A group ends with at most a few open sequences, so larger ones only cost time.
GROUP = 4096
#: Groups of a packing task, where that still gives each core a task. Each task writes a file of its own.
TASK_GROUPS = 4


class SumOfSquares:
    """Sequences of `size` tokens by their gap; a piece goes where the squared counts of open sequences per gap become smallest.

    A new sequence is opened only when a piece fits into none. Ties go to the smallest gap.
    """

    def __init__(self, size: int) -> None:
        self.size, self.made = size, 0
        self.count = np.zeros(size + 1, np.int64)
        self.open: list[list[int]] = [[] for _ in range(size + 1)]

    def place(self, length: int) -> tuple[int, int]:
        """(sequence, offset) of a piece of 1 to size tokens."""
        here = self.count[length:]  # sequences with the gaps that it fits into
        if not here.any():
            nth, gap = self.made, self.size
            self.made += 1
        else:
            # moving a sequence from gap g to gap g - length changes the sum by 2 (count[g - length] - count[g] + 1)
            change = 2 * (self.count[: len(here)] - here + 1)
            change[0] = 1 - 2 * here[0]  # a full sequence is open no more
            change[here == 0] = np.iinfo(np.int64).max
            gap = length + int(change.argmin())
            nth = self.open[gap].pop()
            self.count[gap] -= 1
        rest = gap - length
        if rest:
            self.count[rest] += 1
            self.open[rest].append(nth)
        return nth, self.size - gap


def cut(docs: DataFrame, tokenizer: str, end_id: int, size: int, key: str = "doc_id") -> DataFrame:
    """Stage the pieces of all documents: (key, uid, piece, start, length, ids as 32-bit numbers).

    Each document is its ids and end_id; one of more than `size` ids is cut into pieces of that many, and a last one.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer, added=True)
        for batch in batches:
            for at, ids, counts in encoder.batches(batch.column(2)):
                ids = np.insert(ids, np.cumsum(counts), end_id).astype("<u4")
                n = counts + 1
                pieces = -(-n // size)
                doc = np.repeat(np.arange(len(n)), pieces)
                nth = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                length = np.minimum(size, n[doc] - nth * size)
                rows = pa.array(doc + at)
                yield pa.record_batch(
                    [
                        batch.column(0).take(rows), batch.column(1).take(rows), pa.array(nth.astype(np.int32)), pa.array(nth * size),
                        pa.array(length), binary_rows(ids, length),
                    ],
                    [key, "uid", "piece", "start", "length", "ids"],
                )

    rows = docs.select(F.col(key).cast("long"), F.monotonically_increasing_id().alias("uid"), "text")
    return stage(rows.mapInArrow(task, f"{key} long, uid long, piece int, start long, length long, ids binary"), "pack-pieces", "zstd")


def assign(pieces: DataFrame, size: int, group: int = GROUP) -> DataFrame:
    """Add sequence_id and offset to staged pieces; of ids it reads what columns of pieces are made from, once.

    Pieces that aren't full are dealt by a hash into groups of about `group` pieces; each group is packed by itself in
    falling order of length, so that groups are independent and small. Full pieces, which are sequences of their own,
    are in groups beside those.
    """
    spark = pieces.sparkSession
    n, full = pieces.agg(F.count_if(F.col("length") < size), F.count_if(F.col("length") == size)).first()
    groups, wholes = max(1, n // group), max(1, full // group)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, packer = None, None
        for batch in batches:
            lengths, of = batch.column(batch.schema.get_field_index("length")).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
            out = []
            for length, g in zip(lengths, of, strict=True):
                if g != now:
                    now, packer = g, SumOfSquares(size)
                nth, offset = packer.place(length)
                out.append(((g << 32) + nth, offset))
            a = np.array(out, np.int64).reshape(-1, 2)
            yield pa.record_batch([*batch.columns[:-1], pa.array(a[:, 0]), pa.array(a[:, 1])], [*batch.schema.names[:-1], "sequence_id", "offset"])

    deal = F.xxhash64("uid", "piece")
    of = F.when(F.col("length") < size, F.pmod(deal, F.lit(groups))).otherwise(groups + F.pmod(deal, F.lit(wholes)))
    ordered = pieces.withColumn("_group", of).repartition(tasks(spark, groups + wholes), "_group").sortWithinPartitions("_group", F.desc("length"), "uid", "piece")
    return ordered.mapInArrow(task, f"{types}, sequence_id long, offset long")


def tasks(spark: SparkSession, groups: int) -> int:
    """Tasks for so many groups: TASK_GROUPS to each, but as many as there are cores, and no more than spark.sql.shuffle.partitions."""
    return max(1, min(groups, max(spark.sparkContext.defaultParallelism, groups // TASK_GROUPS), int(spark.conf.get("spark.sql.shuffle.partitions"))))


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids): the packed sequences, each of which a task makes from at most `size` ids."""
    rows = placed.select("uid", "piece", "sequence_id", "offset").join(pieces.select("uid", "piece", "length", "ids"), ["uid", "piece"])
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return rows.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.unhex(F.array_join(F.transform(parts, lambda x: F.hex(x["ids"])), "")).alias("ids"))


def pack(docs: DataFrame, tokenizer: str | None = None, size: int = 2048, end_id: int = 0) -> DataFrame:
    """Where each piece of each document lies: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is its end id alone. Repeated rows and equal ids are packed one by one.
    """
    pieces = cut(docs, tokenizer or vocabulary(), end_id, size)
    digests = pieces.select("doc_id", "uid", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return assign(digests, size).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_sum_of_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into sequences of 2048 tokens."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
