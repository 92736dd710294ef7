import zlib

import pytest
from helpers import SMALL

from docmill.llm import sharding


def check(rows, texts, shards):
    """Contiguous ranges of the key order, cut where the middle of a row's bytes says; slots gapless."""
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.size, r.text_crc32) for r in rows) == sorted((i if i is not None else -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    total, before = sum(r.size for r in rows), 0
    for s in range(shards):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
    last = None
    for r in sorted(rows, key=lambda r: (r.shard, r.slot)):
        assert last is None or last <= (r.doc_id is not None, r.doc_id or 0)
        last = (r.doc_id is not None, r.doc_id or 0)
        assert r.shard == min(shards - 1, (2 * before + r.size) * shards // (2 * total))
        before += r.size


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_edge_rows(docs, shards):
    check(sharding.digest(docs, shards).collect(), [(r.doc_id, r.text) for r in docs.collect()], shards)


def test_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    check(sharding.digest(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()], 16)


def test_hot_key(spark):
    """One key has a third of all rows, which are equal; shards stay even."""
    docs = spark.range(6000).selectExpr("if(id % 3 = 0, 7, id) AS doc_id", "if(id % 3 = 0, 'same', cast(id as string)) AS text")
    sizes = {r.shard: r["b"] for r in sharding.digest(docs, 8).groupBy("shard").agg({"size": "sum"}).withColumnRenamed("sum(size)", "b").collect()}
    assert max(sizes.values()) - min(sizes.values()) < 20


def test_empty(none):
    assert sharding.digest(none).count() == 0


def test_ranges_by_binary_search(spark):
    """As many cuts as there may be at full scale; keys below, between, on and above them, ties settled by the row number."""
    from bisect import bisect_right

    from pyspark.sql import functions as F

    for n in (0, 1, 2, 3, 7, 8, 5000):
        cuts = sorted({(3 * (i // 2), 10 * (i % 2)) for i in range(n)})
        rows = [(k, u) for k in (-(2**63), -1, 0, 1, 3, 3 * n // 4, 3 * (n // 2), 2**62) for u in (-1, 0, 5, 10, 11)]
        got = spark.createDataFrame(rows, "k long, uid long").select("k", "uid", sharding._bucket((F.col("k"), F.col("uid")), cuts).alias("at")).collect()
        assert [r["at"] for r in got] == [bisect_right(cuts, (r.k, r.uid)) for r in got]
