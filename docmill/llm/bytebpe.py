"""Byte-level BPE encoding and decoding by the ranks of a tiktoken file, with the tokenizers library."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .pieces import binary_rows, byte_encoder, gather, read_ranks


class ByteTable:
    """Bytes of each id, as one buffer with places."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.length = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.start = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids, one after the other."""
        return gather(self.flat, self.start[ids], self.length[ids])

    def byte_offsets(self, ids: np.ndarray) -> np.ndarray:
        """Where each id's bytes begin in the text's UTF-8."""
        length = self.length[ids]
        return np.cumsum(length) - length

    def character_offsets(self, ids: np.ndarray) -> np.ndarray:
        """The character that each id begins in. An id may begin inside a character that an earlier one has begun."""
        data = self.decode(ids)
        nth = np.cumsum((data & 0xC0) != 0x80) - 1
        return nth[self.byte_offsets(ids)]


@functools.lru_cache(maxsize=2)
def byte_table(path: str) -> ByteTable:
    return ByteTable(read_ranks(path))


def decode_text(table: ByteTable, ids: np.ndarray) -> str:
    """Text of ids; a character that is split over ids is put together, one that is incomplete becomes U+FFFD."""
    return table.decode(ids).tobytes().decode("utf-8", "replace")


OUT = "ids binary, n_tokens long, byte_starts binary, character_starts binary"


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", offsets: bool = False) -> DataFrame:
    """(key, ids, n_tokens, byte_starts, character_starts) of each text: little-endian unsigned 32-bit numbers.

    Special tokens' strings are ordinary text. A null text counts as empty, and has no ids.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, table = byte_encoder(path, pattern), byte_table(path)
        for batch in batches:
            for at, ids, counts in encoder.batches(batch.column(1)):
                n = len(counts)
                starts = [pa.nulls(n, pa.binary())] * 2
                if offsets:
                    each = np.split(ids, np.cumsum(counts)[:-1])
                    starts = [pa.array([f(x).astype("<u4").tobytes() for x in each], pa.binary()) for f in (table.byte_offsets, table.character_offsets)]
                yield pa.record_batch(
                    [batch.column(0).slice(at, n), binary_rows(ids.astype("<u4"), counts), pa.array(counts), *starts],
                    [key, "ids", "n_tokens", "byte_starts", "character_starts"],
                )

    return docs.select(F.col(key).cast("long"), "text").mapInArrow(task, f"{key} long, {OUT}")


def decode(rows: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, ids, n_tokens, decoded) with the bytes that the ids stand for. Null ids count as none."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = byte_table(path)
        for batch in batches:
            got = [np.frombuffer(x.as_buffer() if x.is_valid else b"", "<u4") for x in batch.column(1)]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array([len(x) for x in got], pa.int64()), pa.array([table.decode(x).tobytes() for x in got], pa.binary())],
                [key, "ids", "n_tokens", "decoded"],
            )

    return rows.select(key, ids).mapInArrow(task, f"{key} long, ids binary, n_tokens long, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """encode() and decode() in one pass of one worker, for each text whole: (key, n_tokens, ids, decoded, character_starts, n_split).

    character_starts has the character that each id begins in, n_split counts the ids that begin inside a character.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, table = byte_encoder(path, pattern), byte_table(path)
        for batch in batches:
            for at, ids, counts in encoder.batches(batch.column(1)):
                data = table.decode(ids)
                places = np.concatenate([[0], np.cumsum(table.length[ids])])  # of ids among the bytes
                ends = np.cumsum(counts)
                inside = (data & 0xC0) == 0x80
                nth = np.concatenate([np.cumsum(~inside), [0]]) - 1
                first = np.repeat(nth[places[ends - counts]], counts)  # the first character of each id's text
                split = np.concatenate([[0], np.cumsum(inside[places[:-1]])])
                yield pa.record_batch([
                    batch.column(0).slice(at, len(counts)), pa.array(counts), binary_rows(ids.astype("<u4"), counts), binary_rows(data, places[ends] - places[ends - counts]),
                    binary_rows((nth[places[:-1]] - first).astype("<u4"), counts), pa.array(split[ends] - split[ends - counts]),
                ], [key, "n_tokens", "ids", "decoded", "character_starts", "n_split"])

    return docs.select(F.col(key).cast("long"), "text").mapInArrow(
        task, f"{key} long, n_tokens long, ids binary, decoded binary, character_starts binary, n_split long",
    )


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded again."""
    import public_tokenizers as P

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digest(docs, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)


def digest(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """The contract's columns, and those of the offsets."""
    back = round_trip(docs, path, pattern)
    return back.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
        F.crc32("character_starts").alias("offsets_crc32"), "n_split",
    )
