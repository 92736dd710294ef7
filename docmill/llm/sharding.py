"""Sharding by sampled splitters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import stage

#: Keys that a sample holds at most, on average; a bound on what the driver gets in a round.
SAMPLE = 20_000
#: A range is overfull beyond so many times the mean, and is then cut again.
OVERFULL = 1.5
ROUNDS = 4


def _bucket(key: tuple[Column, Column], cuts: list[tuple[int, int]]) -> Column:
    """Index of the range that a (key, uid) pair falls into: a binary search in the cuts, in the JVM. Two constant arrays
    hold the cuts, so the expression is small however many there are."""
    if not cuts:
        return F.lit(0)
    keys, uids = (F.split(F.lit(",".join(str(c[i]) for c in cuts)), ",").cast("array<bigint>") for i in (0, 1))
    steps = F.array(*[F.lit(1 << p) for p in reversed(range(len(cuts).bit_length()))])

    def further(at: Column, step: Column) -> Column:
        k, u = F.get(keys, at + step - 1), F.get(uids, at + step - 1)  # null beyond the last cut
        return F.when((key[0] > k) | ((key[0] == k) & (key[1] >= u)), at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), further)


def _quantiles(sample: list[tuple[int, int, float]], parts: int) -> list[tuple[int, int]]:
    """Boundaries that cut the sampled weight into equal parts."""
    sample = sorted(sample)
    total, seen, cuts = sum(w for *_, w in sample), 0.0, []
    for k, u, w in sample:
        if seen >= total * (len(cuts) + 1) / parts and len(cuts) < parts - 1:
            cuts.append((k, u))
        seen += w
    return cuts


def _draw(rows: DataFrame, size: int, total: int, where: Column | None = None) -> list[tuple[int, int, float]]:
    """A sample in which a row's chance is proportional to its size (1 at most), with weights that undo the rest."""
    chance = F.least(F.lit(1.0), F.col("size") * F.lit(float(size)) / F.lit(float(max(total, 1))))
    draw = F.pmod(F.xxhash64("uid", F.lit(7)), F.lit(2**53)) / F.lit(2.0**53)
    rows = rows if where is None else rows.filter(where)
    got = rows.filter(draw < chance).select("k", "uid", (F.col("size") / chance).alias("w")).collect()
    return [(r.k, r.uid, float(r.w)) for r in got]


def shard(docs: DataFrame, shards: int, key: str = "doc_id", size: Column | None = None, ranges: int | None = None) -> DataFrame:
    """Range-partition rows by key into shards of near equal bytes.

    Draws a size-weighted sample of keys, cuts the key space at its quantiles, measures each range in full, and cuts
    overfull ranges again. Inside each range, rows are summed in key order; a row's shard is where the middle of its
    bytes falls among the bytes of all rows. A row number breaks ties, so rows of one key may lie in two shards, and a
    hot key or repeated rows are no obstacle. Null keys come first. An empty table gives no rows.

    Returns key, uid, size, shard (int), slot (place in the shard, gapless from 0) and what `docs` has under `keep_`.
    Only keys and sizes are shuffled, never texts.
    """
    spark = docs.sparkSession
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 1 if size is None else size
    kept = [c for c in docs.columns if c.startswith("keep_")]
    rows = stage(
        docs.select(
            F.col(key).cast("long").alias("key"), F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))).alias("k"),
            F.monotonically_increasing_id().alias("uid"), size.cast("long").alias("size"), *kept,
        ),
        "shard-rows",
    )
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    # enough ranges that none is more than a task's work, and each boundary still has many sampled keys to its side
    ranges = ranges or max(shards * 4, min(2048, int(spark.conf.get("spark.sql.shuffle.partitions")), max(1, n // 1000)))
    cuts = _quantiles(_draw(rows, min(SAMPLE, max(n, 1)), total), ranges)
    for _ in range(ROUNDS):
        held = {r["range"]: r["bytes"] for r in rows.groupBy(_bucket((F.col("k"), F.col("uid")), cuts).alias("range")).agg(F.sum("size").alias("bytes")).collect()}
        over = [i for i, b in held.items() if b > OVERFULL * total / ranges]
        if not over or len(cuts) > 4 * ranges:
            break
        inner = _draw(rows.withColumn("range", _bucket((F.col("k"), F.col("uid")), cuts)), min(SAMPLE, max(n, 1)) * 4, total, F.col("range").isin(over))
        edges = [(-(2**63), -1), *cuts, (2**63 - 1, 2**63 - 1)]
        more = []
        for i in over:
            inside = [x for x in inner if edges[i] <= x[:2] < edges[i + 1]]
            more += [c for c in _quantiles(inside, -(-held[i] * ranges // max(total, 1)) + 1) if c > edges[i]]
        if not more:
            break
        cuts = sorted({*cuts, *more})
    ranged = rows.withColumn("range", _bucket((F.col("k"), F.col("uid")), cuts))
    order = Window.partitionBy("range").orderBy("k", "uid")
    inside = stage(ranged.select("*", (F.sum("size").over(order) - F.col("size")).alias("before"), (F.row_number().over(order) - 1).alias("nth")), "shard-order")
    base, row, bases = 0, 0, []
    for r in sorted(inside.groupBy("range").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect(), key=lambda r: r["range"]):  # a row for each range
        bases.append((r["range"], base, row))
        base, row = base + r.b, row + r.n
    schema = T.StructType([T.StructField("range", T.IntegerType()), T.StructField("base", T.LongType()), T.StructField("row", T.LongType())])
    # exact: twice the middle of a row's bytes, among twice all bytes
    placed = inside.join(F.broadcast(spark.createDataFrame(bases, schema)), "range").select(
        "key", "uid", "size", *kept,
        F.least(F.lit(shards - 1), F.expr(f"cast(({shards} * cast(2 * (base + before) + size as decimal(30,0))) div {max(2 * total, 1)} as int)")).alias("shard"),
        (F.col("row") + F.col("nth")).alias("_nth"),
    )
    first = placed.groupBy("shard").agg(F.min("_nth").alias("_first"))  # a row for each shard
    return placed.join(F.broadcast(first), "shard").select("key", "uid", "size", *kept, "shard", (F.col("_nth") - F.col("_first")).cast("long").alias("slot"))


def op1_sampled_splitters(spark, sf_dir: str) -> DataFrame:
    """All documents into 16 shards of near equal bytes."""
    return digest(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def digest(docs: DataFrame, shards: int = 16) -> DataFrame:
    """The contract's columns. A null text has size 1 and the checksum of an empty one."""
    crc = F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    out = shard(docs.select("doc_id", "text", crc.alias("keep_crc")), shards)
    return out.select(
        F.col("key").alias("doc_id"), "size", F.col("keep_crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


#: Places among all bytes by window sums; CRC-32 by halves of bytes, low half first, from a table made of the polynomial.
OP1_SQL = """
WITH c AS (SELECT list_transform(range(16), lambda n: list_reduce(list_prepend(n, range(4)), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))) AS halves),
d AS (SELECT doc_id, encode(coalesce(text, '')) AS t FROM documents),
h AS (SELECT doc_id, octet_length(t) + 1 AS size, list_transform(regexp_extract_all(hex(t), '.'), lambda x: ('0x' || x)::BIGINT) AS l FROM d),
s AS (
  SELECT doc_id, size, list_reduce(list_prepend(4294967295, list_transform(range(len(l)), lambda i: l[xor(i, 1) + 1])), lambda c, b: xor(c >> 4, halves[(xor(c, b) & 15) + 1])) AS crc FROM h, c
),
o AS (SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) - size AS before, sum(size) OVER () AS total FROM s),
p AS (SELECT *, least(15, 16 * (2 * before + size) // (2 * total))::INTEGER AS shard FROM o)
SELECT doc_id, size::BIGINT AS size, xor(crc, 4294967295)::BIGINT AS text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM p
"""
