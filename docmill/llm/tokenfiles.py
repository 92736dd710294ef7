"""Token-id files: frequency-ranked variable-length coding, and flat files whose documents a separator scan finds."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import new_path, stage
from .pieces import binary_rows, numbers, slices, word_encoder
from .warc import _mkdir

#: Ids that a coded file holds at most, but for one longer document.
FILE_IDS = 4 << 20
#: Bytes of ids that are coded at once, and numbers that are decoded at once; a longer document is a run of its own.
RUN_BYTES, RUN_IDS = 1 << 20, 1 << 19
MAGIC = b"DMVB1\n\0\0"


def vocabulary() -> str:
    """The path of the default tokenizer. Every function takes another as a parameter."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encoded(docs: DataFrame, tokenizer: str, end_id: int, vocab: int) -> DataFrame:
    """Stage each document's ids: (kind 0, doc_id, uid, n, ids as little-endian 16- or 32-bit numbers, by vocab).

    Each task adds a row of kind 1, whose ids hold how often it met each id (64-bit numbers, vocab of them).
    """
    wide = "<u4" if vocab > 1 << 16 else "<u2"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen = word_encoder(tokenizer, added=True), np.zeros(vocab, np.int64)
        for batch in batches:
            for at, ids, counts in encoder.batches(batch.column(2)):
                n = len(counts)
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, end_id)
                seen += np.bincount(ids, minlength=vocab)
                yield pa.record_batch(
                    [
                        pa.array(np.zeros(n, np.int32)), batch.column(0).slice(at, n), batch.column(1).slice(at, n), pa.array(counts + 1),
                        binary_rows(ids.astype(wide), counts + 1),
                    ],
                    names,
                )
        yield pa.record_batch(
            [
                pa.array([1], pa.int32()), pa.array([None], pa.int64()), pa.array([None], pa.int64()), pa.array([0], pa.int64()),
                pa.array([seen.tobytes()], pa.binary()),
            ],
            names,
        )

    names = ["kind", "doc_id", "uid", "n", "ids"]
    rows = docs.select(F.col("doc_id").cast("long"), F.monotonically_increasing_id().alias("uid"), "text")
    return stage(rows.mapInArrow(task, "kind int, doc_id long, uid long, n long, ids binary"), "token-ids", "zstd")


def ranks(table: DataFrame, vocab: int) -> np.ndarray:
    """Ids by falling frequency over the whole corpus (ties by id), from encoded()'s counts; the driver gets a row for each id."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocab, np.int64)
        for batch in batches:
            for x in batch.column(0):
                total += np.frombuffer(x.as_buffer(), np.int64)
        some = np.flatnonzero(total)
        if len(some):
            yield pa.record_batch([pa.array(some), pa.array(total[some])], ["id", "n"])

    counts = np.zeros(vocab, np.int64)
    for r in table.filter("kind = 1").select("ids").mapInArrow(add, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[r["id"]] = r["n"]
    return np.lexsort((np.arange(vocab), -counts)).astype(np.uint32)


def _slots(lengths: np.ndarray) -> np.ndarray:
    """Where the two control bits of each number are, in pairs of bits, if each run of so many numbers begins at a control byte of its own."""
    room = -(-lengths // 4) * 4
    return np.arange(int(lengths.sum())) + np.repeat((np.cumsum(room) - room) - (np.cumsum(lengths) - lengths), lengths)


def pack_numbers(values: np.ndarray, lengths: np.ndarray | None = None) -> tuple[bytes, bytes]:
    """(control bytes, data bytes): two control bits give a number's bytes less one, four numbers to a control byte.

    With lengths, the numbers are runs of so many, each of which begins at a control byte of its own.
    """
    values, lengths = np.ascontiguousarray(values, "<u4"), np.array([len(values)]) if lengths is None else lengths
    more = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4, dtype=np.uint8) <= more[:, None]]
    codes = np.zeros(int((-(-lengths // 4)).sum()) * 4, np.uint8)
    codes[_slots(lengths)] = more
    return (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8).tobytes(), data.tobytes()


#: The four widths that a control byte stands for.
WIDTHS = (((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1).astype(np.uint8)


def unpack_numbers(control: np.ndarray, data: np.ndarray, n: int | np.ndarray) -> np.ndarray:
    """The first n numbers, or those of runs of n[0], n[1].. numbers: their widths by table lookup, their bytes by shifts."""
    width = WIDTHS[control].reshape(-1)
    width = width[:n] if np.isscalar(n) else width[_slots(n)]
    start = np.cumsum(width, dtype=np.int64) - width
    data = np.concatenate([data, np.zeros(4, np.uint8)]).astype(np.uint32)
    out = data[start]
    for k in (1, 2, 3):
        at = np.flatnonzero(width > k)
        out[at] |= data[start[at] + k] << np.uint32(8 * k)
    return out


def write_coded(table: DataFrame, rank_ids: np.ndarray, path: str) -> DataFrame:
    """Write encoded() documents under path in ascending order of doc_id (null first; ties as they were read).

    Numbers are coded after the shuffle, as the sample of its ranges reads its input once more.

    A file: magic; numbers of documents, ids, control and data bytes; doc_ids, null marks and lengths; control bytes;
    data bytes. The table of ranks is a file beside them. Tasks are ranges of doc_id, so file names follow the order.
    """
    order = np.argsort(rank_ids).astype(np.uint32)  # id to rank
    wide = "<u4" if len(rank_ids) > 1 << 16 else "<u2"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(path)
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        held, ids, nth, done = [], 0, 0, []  # held: doc_ids, null marks, lengths, control and data bytes of runs of documents

        def close() -> None:
            target, own = f"{root}/part-{part:06d}-{nth:05d}.dmvb", f"{root}/_tmp-{part}-{nth}-{attempt}"
            documents = sum(len(h[0]) // 8 for h in held)
            with store.open_output_stream(own) as f:
                f.write(MAGIC + struct.pack("<4Q", documents, ids, sum(len(h[3]) for h in held), sum(len(h[4]) for h in held)))
                for k in range(5):
                    for h in held:
                        f.write(h[k])
            store.move(own, target)
            done.append((target, documents, ids))

        for batch in batches:
            at = 0
            for raw in slices(batch.column(3), RUN_BYTES):
                doc_ids, lengths = batch.column(0).slice(at, len(raw)), batch.column(2).slice(at, len(raw)).to_numpy()
                at += len(raw)
                values = order[numbers(raw, wide)]
                ends, first, before = np.cumsum(lengths), 0, 0
                while first < len(raw):
                    # up to the document that fills the file, or all
                    stop = min(len(raw), int(np.searchsorted(ends, before + FILE_IDS - ids, side="right")) + 1)
                    n = lengths[first:stop]
                    held.append((
                        doc_ids[first : stop].fill_null(0).to_numpy().astype("<i8").tobytes(), doc_ids[first : stop].is_null().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes(),
                        n.astype("<u8").tobytes(), *pack_numbers(values[before : ends[stop - 1]], n),
                    ))
                    ids += int(n.sum())
                    first, before = stop, int(ends[stop - 1])
                    if ids > FILE_IDS:
                        close()
                        held, ids, nth = [], 0, nth + 1
        if held:
            close()
        if done:
            yield pa.record_batch([pa.array(x) for x in zip(*done, strict=True)], ["file", "documents", "ids"])

    _mkdir(path)
    store_ranks(rank_ids, path)
    rows = table.filter("kind = 0").select("doc_id", "uid", "n", "ids")
    parts = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), "uid").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "uid")
    return stage(ordered.mapInArrow(task, "file string, documents long, ids long"), "token-files")


def store_ranks(rank_ids: np.ndarray, path: str) -> None:
    """The table from ranks to ids, which all files under path share; its size is the vocabulary's."""
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(path)
    with store.open_output_stream(f"{root}/ranks.u4") as f:
        f.write(rank_ids.astype("<u4").tobytes())


def load_ranks(path: str) -> np.ndarray:
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(path)
    with store.open_input_file(f"{root}/ranks.u4") as f:
        return np.frombuffer(f.read(), "<u4")


def decode_file(content: bytes | pa.Buffer, rank_ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(doc_ids, null marks, lengths, ids) of runs of a file's documents. Each document's numbers begin at a control byte of their own."""
    if bytes(memoryview(content)[:8]) != MAGIC:
        raise ValueError("not a coded token file")
    n, _, controls, _ = struct.unpack_from("<4Q", content, 8)
    at = 40
    doc_ids = np.frombuffer(content, "<i8", n, at)
    null = np.frombuffer(content, np.uint8, n, at + 8 * n).astype(bool)
    lengths = np.frombuffer(content, "<u8", n, at + 9 * n).astype(np.int64)
    raw = np.frombuffer(content, np.uint8, offset=at + 17 * n)
    control, data = raw[:controls], raw[controls:]
    ends, used = np.cumsum(lengths), np.concatenate([[0], np.cumsum(-(-lengths // 4))])
    first, d = 0, 0
    while first < n:
        base = ends[first] - lengths[first]
        stop = max(first + 1, int(np.searchsorted(ends, base + RUN_IDS, side="right")))
        mine, sizes = control[used[first] : used[stop]], lengths[first:stop]
        # what fills up a document's last control byte has no data, though its bits say one byte
        size = int(WIDTHS[mine].sum(dtype=np.int64)) - int((-sizes % 4).sum())
        yield doc_ids[first:stop], null[first:stop], sizes, rank_ids[unpack_numbers(mine, data[d : d + size], sizes)]
        first, d = stop, d + size


def read_coded(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """Documents of the files under path: doc_id, part, file, nth, n_tokens, ids_crc32 and, if asked for, ids (32-bit)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = load_ranks(path)
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                part, file = map(int, name.rpartition("/")[2].removesuffix(".dmvb").split("-")[1:])
                nth = 0
                for doc_ids, null, lengths, got in decode_file(content.as_buffer(), table):
                    n, got = len(lengths), got.astype("<u4")
                    raw, ends = memoryview(got).cast("B"), (4 * np.cumsum(lengths)).tolist()
                    crc = [zlib.crc32(raw[a:b]) for a, b in zip([0, *ends], ends)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(doc_ids, mask=null), pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, file, np.int32)), pa.array(nth + np.arange(n)),
                            pa.array(lengths), pa.array(crc, pa.int64()), binary_rows(got, lengths) if ids else pa.nulls(n, pa.binary()),
                        ],
                        names=["doc_id", "part", "file", "nth", "n_tokens", "ids_crc32", "ids"],
                    )
                    nth += n

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.dmvb").load(path).select("path", "content")
    return files.mapInArrow(task, "doc_id long, part int, file int, nth long, n_tokens long, ids_crc32 long, ids binary")


def with_starts(rows: DataFrame, size: str, keys: tuple[str, str, str] = ("part", "file", "nth")) -> DataFrame:
    """Add `start`: the sum of size over all rows before, in the order of keys; rows must be staged.

    Sums inside a file, then over a part's files, then over the parts (of which there are as many as write tasks).
    """
    part, file, nth = keys
    files = rows.groupBy(part, file).agg(F.sum(size).alias("_n"))
    parts = files.groupBy(part).agg(F.sum("_n").alias("_n")).select(part, (F.sum("_n").over(Window.orderBy(part)) - F.col("_n")).alias("_p"))
    base = files.select(part, file, (F.sum("_n").over(Window.partitionBy(part).orderBy(file)) - F.col("_n")).alias("_f")).join(parts, part)
    inside = Window.partitionBy(part, file).orderBy(nth)
    return rows.withColumn("_before", F.sum(size).over(inside) - F.col(size)).join(base, [part, file]).withColumn("start", (F.col("_before") + F.col("_f") + F.col("_p")).cast("long")).drop("_before", "_f", "_p")


def op5_ranked_varint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into coded files and back."""
    return ranked_round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def ranked_round_trip(docs: DataFrame, tokenizer: str | None = None, vocab: int = 49408, end_id: int = 1) -> DataFrame:
    """Encode, count, rank, write, read; an empty or null text is its end id alone. Equal doc_ids are rows of their own."""
    spark = docs.sparkSession
    table = encoded(docs, tokenizer or vocabulary(), end_id, vocab)
    path = new_path(spark, "coded")
    write_coded(table, ranks(table, vocab), path)
    back = stage(read_coded(spark, path, ids=False).drop("ids"), "token-back")
    return with_starts(back, "n_tokens").select("doc_id", "start", "n_tokens", "ids_crc32")


#: Numbers in a flat file, and in the block that one search covers.
FLAT_IDS = 16 << 20
BLOCK_IDS = 1 << 20


def write_flat(docs: DataFrame, path: str, tokenizer: str, end_id: int, wide: str = "<u2") -> DataFrame:
    """Write ids as flat files of `wide` numbers under path, documents as they are read, end_id after each; no index.

    Each task writes its own part, so nothing is shuffled. Its files are cut at FLAT_IDS wherever that falls. Returns
    (doc_id, part, nth) as they were written.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(path)
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        encoder, room, file, nth, out, own = word_encoder(tokenizer), 0, -1, 0, None, ""

        def close() -> None:
            if out is not None:
                out.close()
                store.move(own, f"{root}/part-{part:06d}-{file:05d}.flat")

        for batch in batches:
            for at, ids, counts in encoder.batches(batch.column(1)):
                ids = np.insert(ids, np.cumsum(counts), end_id).astype(wide)
                while len(ids):
                    if not room:
                        close()
                        room, file = FLAT_IDS, file + 1
                        own = f"{root}/_tmp-{part}-{file}-{attempt}"
                        out = store.open_output_stream(own)
                    out.write(ids[:room].tobytes())
                    room, ids = room - min(room, len(ids)), ids[room:]
                n = len(counts)
                yield pa.record_batch(
                    [batch.column(0).slice(at, n), pa.array(np.full(n, part, np.int32)), pa.array(np.zeros(n, np.int32)), pa.array(nth + np.arange(n))],
                    ["doc_id", "part", "file", "nth"],
                )
                nth += n
        close()

    _mkdir(path)
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return stage(rows.mapInArrow(task, "doc_id long, part int, file int, nth long"), "flat-order")


def separators(spark: SparkSession, path: str, end_id: int, block: int = BLOCK_IDS, wide: str = "<u2") -> DataFrame:
    """Documents of the flat files under path, which has no index: (part, nth, n_tokens, start), n_tokens with the end id.

    Each task searches blocks of a file at once for end_id. What it reports for a block is the lengths between its own
    separators, and the ids after its last one; a prefix scan over (part, file, block) adds to a block's first document
    what earlier blocks left open. Ids after a task's last separator are no document.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(path)
        for batch in batches:
            for name, nth in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part, file = map(int, name.rpartition("/")[2].removesuffix(".flat").split("-")[1:])
                with store.open_input_file(f"{root}/{name.rpartition('/')[2]}") as f:
                    f.seek(size * block * nth)
                    ids = np.frombuffer(f.read(size * block), wide)
                at = np.flatnonzero(ids == end_id)
                lengths = np.diff(at, prepend=-1)
                tail = len(ids) - (at[-1] + 1 if len(at) else 0)
                yield pa.record_batch(
                    [pa.array([v], t) for v, t in ((part, pa.int32()), (file, pa.int32()), (nth, pa.int64()), (int(tail), pa.int64()), (len(ids), pa.int64()), (lengths.astype("<i8").tobytes(), pa.binary()), (len(at), pa.int64()))],
                    names,
                )

    size = np.dtype(wide).itemsize
    names = ["part", "file", "block", "tail", "ids", "lengths", "documents"]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.flat").load(path).select(
        "path", F.expr(f"explode(sequence(0L, greatest(0L, (length - 1) div {size * block})))").alias("block"), "length",
    ).filter("length > 0")
    found = stage(
        files.repartition("path", "block").select("path", "block").mapInArrow(
            task, "part int, file int, block long, tail long, ids long, lengths binary, documents long",
        ),
        "flat-blocks",
    )
    # the scan: a block's open ids are the tails since the last block before it that has a separator
    small = found.drop("lengths")
    by = Window.partitionBy("part").orderBy("file", "block")
    before = F.sum("tail").over(by) - F.col("tail")
    marked = small.withColumn("before", before).withColumn("mark", F.when(F.col("documents") > 0, F.col("before")))
    last = F.last("mark", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, -1))
    open_ = marked.withColumn("open", F.col("before") - F.coalesce(last, F.lit(0)))
    bases = open_.select(
        "part", "file", "block", "open", (F.sum("documents").over(by) - F.col("documents")).alias("first"),
        (F.sum("ids").over(by) - F.col("ids")).alias("ids_before"),
    )
    parts = small.groupBy("part").agg(F.sum("ids").alias("n")).select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_before"))

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                lengths = np.frombuffer(r["lengths"], "<i8").copy()
                if len(lengths):
                    ends = r["part_before"] + r["ids_before"] + np.cumsum(lengths)
                    lengths[0] += r["open"]
                    n = len(lengths)
                    yield pa.record_batch(
                        [pa.array(np.full(n, r["part"], np.int32)), pa.array(r["first"] + np.arange(n)), pa.array(lengths), pa.array(ends - lengths)],
                        ["part", "nth", "n_tokens", "start"],
                    )

    return found.select("part", "file", "block", "lengths").join(bases, ["part", "file", "block"]).join(parts, "part").mapInArrow(unfold, "part int, nth long, n_tokens long, start long")


def op8_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents, found in flat files again. start counts all ids before in the files, end ids too."""
    return scan_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def scan_counts(docs: DataFrame, tokenizer: str | None = None, end_id: int = 49407, block: int = BLOCK_IDS, wide: str = "<u2") -> DataFrame:
    """doc_id, start and n_tokens (without the end id, which no text can hold). A null text counts as empty.

    wide is the number type of the flat files; vocabularies of over 65,536 ids need "<u4".
    """
    path = new_path(docs.sparkSession, "flat")
    order = write_flat(docs, path, tokenizer or vocabulary(), end_id, wide)
    found = separators(docs.sparkSession, path, end_id, block, wide)
    return order.drop("file").join(found, ["part", "nth"]).select("doc_id", "start", (F.col("n_tokens") - 1).alias("n_tokens"))
