"""The near-duplicate join against all pairs by brute force."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import SMALL
from pyspark.sql import functions as F

from docmill.llm import common, near


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """Per row: class and number of links."""
    sets = [shingles(t) for _, t in rows]
    holders = defaultdict(list)
    for n, s in enumerate(sets):
        for x in s:
            holders[x].append(n)
    up, links = list(range(len(rows))), Counter()

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for n, s in enumerate(sets):
        for m, k in Counter(y for x in s for y in holders[x] if y > n).items():
            if k / (len(s) + len(sets[m]) - k) >= 0.8:
                links[n] += 1
                links[m] += 1
                up[max(find(n), find(m))] = min(find(n), find(m))
    least = defaultdict(list)
    for n, (i, _) in enumerate(rows):
        least[find(n)].append((i is None, i))
    return sorted([(i, min(least[find(n)])[1], links[n]) for n, (i, _) in enumerate(rows)], key=str)


def test_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    _, found = near.classes(docs.select("doc_id", "text"))
    assert sorted([(r.id, r.class_id, r.n_links) for r in found.collect()], key=str) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_edge_rows_in_small_blocks(docs, monkeypatch):
    monkeypatch.setattr(near, "BLOCK_TEXTS", 1)
    _, found = near.classes(docs)
    assert sorted([(r.id, r.class_id, r.n_links) for r in found.collect()], key=str) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_one_of_each_class_stays(docs):
    kept = near.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 11 in ids and 12 not in ids and 13 not in ids and ids.count(1) == 1


def test_empty(none):
    assert near.keep_one(none).count() == 0


def test_recall_of_depths():
    assert near.recall(5, 0.8) > near.RECALL > near.recall(6, 0.8)


def test_shingles_of_short_texts():
    flat, count = near.shingles(pa.array(["", None, "a", "a b c d e", "a b c d e f", " a  b\tc d\ne "]))
    assert count.tolist() == [0, 0, 1, 1, 2, 1]
    assert flat[1] == flat[2] == flat[4] and len(np.unique(flat)) == 3


def test_depth_reaches_the_target():
    for similarity in (0.05, 0.1, 0.2, 0.3, 0.5, 0.8, 0.95):
        for target in (0.5, 0.9, 0.999, 1.0):
            assert near.recall(near.depth_for(similarity, target), similarity) >= target


def test_low_similarity_misses_nothing(spark):
    """Pairs that no prefix finds surely, so all texts are compared."""
    texts = [" ".join([f"s{n // 2}x{i}" for i in range(25)] + [f"w{n}x{i}" for i in range(60)]) for n in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    _, found = near.classes(docs, similarity=0.14)
    assert sorted((r.id, r.class_id, r.n_links) for r in found.collect()) == [(i, i - i % 2, 1) for i in range(300)]


def depths(monkeypatch):
    seen, at_depth = [], near._at_depth
    monkeypatch.setattr(near, "_at_depth", lambda company, depth, similarity: (seen.append(depth), at_depth(company, depth, similarity))[1])
    return seen


def edited(n, words, changed):
    """n texts of so many words, each with another run of `changed` words replaced."""
    return [" ".join(f"x{i}y{k}" if i * changed <= k < (i + 1) * changed else f"w{k}" for k in range(words)) for i in range(n)]


def test_prefixes_are_shortened_for_links_near_the_limit(spark, monkeypatch):
    """Texts of similarity 0.82: long prefixes are expected to miss some, so shorter ones are tried, down to those that can't."""
    seen, texts = depths(monkeypatch), edited(60, 190, 14)
    docs = spark.createDataFrame([(100 * g + i, t.replace("w", f"g{g}w")) for g in range(3) for i, t in enumerate(texts[20 * g : 20 * g + 2])], "doc_id long, text string")
    _, found = near.classes(docs)
    assert sorted([(r.id, r.class_id, r.n_links) for r in found.collect()], key=str) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert seen == list(range(near.DEPTH, near.depth_for(near.SIMILARITY, near.RECALL) - 1, -1))


def test_prefixes_stay_long_for_close_copies(spark, monkeypatch):
    """Copies of similarity 0.97 and more all share long prefixes: nothing is shortened, and nothing is missed."""
    seen, texts = depths(monkeypatch), edited(40, 1200, 9)
    _, found = near.classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert sorted((r.id, r.class_id, r.n_links) for r in found.collect()) == [(i, 0, 39) for i in range(40)]
    assert seen == [near.DEPTH]


def test_expected_recall():
    """Links of one similarity are missed as the closed form says; few links prove little; all texts in one node miss nothing."""
    for step in (0, 60, 150):
        found = np.zeros(near.STEPS, int)
        found[step] = 10**6
        assert abs(near.expected_recall(found, 7, 0.8) - near.recall(7, 0.8 + 0.2 * step / near.STEPS)) < 1e-4
    assert near.expected_recall(np.zeros(near.STEPS, int), 7, 0.8) < near.RECALL
    assert near.expected_recall(np.zeros(near.STEPS, int), 0, 0.1) == 1


def test_labels_are_trie_places(spark):
    """A node is a run of the sorted labels; its number has the tree and the leading bytes."""
    from pyspark.sql import functions as F

    rows = [(t, int.from_bytes(bytes([7, 6, 5, 4, 3, 2, 1]), "big") + t) for t in range(near.TREES)]
    got = spark.createDataFrame(rows, "tree int, label long").select("tree", *[near._node(d).alias(f"n{d}") for d in range(near.DEPTH + 1)], F.col("label")).collect()
    for r in got:
        for d in range(near.DEPTH + 1):
            assert r[f"n{d}"] == (r.tree << 8 * near.DEPTH) | (r.label >> 8 * (near.DEPTH - d))


def test_hot_group_of_near_copies(spark, monkeypatch):
    """A third of all texts are near copies of one; blocks are small, and every link is counted once."""
    monkeypatch.setattr(near, "BLOCK_TEXTS", 16)
    texts = edited(90, 900, 8) + [f"other {i} " + " ".join(f"u{i}v{k}" for k in range(30)) for i in range(180)]
    _, found = near.classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert sorted((r.id, r.class_id, r.n_links) for r in found.collect()) == [(i, 0, 89) if i < 90 else (i, i, 0) for i in range(270)]


def test_components_of_a_hub(spark):
    """A hub with most edges, a chain, a loop and a pair."""
    from docmill.llm import common

    edges = [(0, i) for i in range(1, 800)] + [(1000 + i, 1001 + i) for i in range(30)] + [(5000, 5000), (7001, 7000)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    assert got == {**dict.fromkeys(range(800), 0), **dict.fromkeys(range(1000, 1031), 1000), 7000: 7000, 7001: 7000}


def copies(n, words, changed):
    """n texts of so many words, each the same but for a few words at a place of its own."""
    return [" ".join(f"x{i}y{k}" if (i * 37 + 5 * c) % words == k else f"w{k}" for k, c in ((k, k % changed) for k in range(words))) for i in range(n)]


def test_a_large_group_is_compared_with_its_centre(spark, monkeypatch):
    """Six hundred near copies, and some texts near the limit: no pair inside of a ball is compared, and no link is lost."""
    monkeypatch.setattr(near, "BLOCK_TEXTS", 32)
    compared, verify = spark.sparkContext.accumulator(0), near._verify

    def counted(uids, own, copies, labels, balls, flat, count, across, *rest):
        """Pairs of the block that aren't of one ball, in all trees."""
        apart = (balls[:, None] != balls[None]) | (balls < 0)[:, None]
        apart &= own[:, None] & ~own[None] if across else np.arange(len(uids))[:, None] < np.arange(len(uids))[None]
        compared.add(int(apart.sum()))
        return verify(uids, own, copies, labels, balls, flat, count, across, *rest)

    monkeypatch.setattr(near, "_verify", counted)
    texts = copies(600, 300, 1) + edited(3, 300, 30) + [f"other {i} " + " ".join(f"u{i}v{k}" for k in range(30)) for i in range(50)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    _, found = near.classes(docs)
    assert sorted([(r.id, r.class_id, r.n_links) for r in found.collect()], key=str) == brute(list(enumerate(texts)))
    assert compared.value < 600 * 600 / 2 / 5  # of all pairs of the group, which would be met in several trees


@pytest.mark.parametrize("n", [400, 1200])
def test_text_rows_grow_in_proportion(spark, monkeypatch, n):
    """Of more near copies in one node, each text is sent to a bounded number of blocks, not to as many as the node has chunks."""
    monkeypatch.setattr(near, "BLOCK_TEXTS", 24)
    sent = spark.sparkContext.accumulator(0)
    blocks = near._blocks

    def counted(depth, similarity):
        task = blocks(depth, similarity)

        def run(batches):
            def count():
                for b in batches:
                    sent.add(b.num_rows)
                    yield b

            yield from task(count())

        return run

    monkeypatch.setattr(near, "_blocks", counted)
    texts = copies(n, 300, 1) + edited(3, 300, 30)
    _, found = near.classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert found.filter("class_id = 0").count() >= n
    assert sent.value < 45 * n  # 20 trees, a few copies each; a chunk with each other one would be over 500 for the larger n


def test_components_end_with_stars(spark, monkeypatch):
    """No round is spent on stars, nor on finding that nothing changes any more."""
    calls, star = [], common._star
    monkeypatch.setattr(common, "_star", lambda *a: calls.append(a[1]) or star(*a))

    def of(edges):
        return {r.node: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}

    assert of([(5, 1), (1, 6), (9, 8), (5, 1)]) == {1: 1, 5: 1, 6: 1, 8: 8, 9: 8} and calls == []
    assert of([]) == {} and of([(1, 2), (2, 3), (7, 7)]) == {1: 1, 2: 1, 3: 1} and calls == [True, False]
    chain = [(i, i + 1) for i in range(40)] + [(100 - i, 99 - i) for i in range(20)]
    assert of(chain) == {i: 0 for i in range(41)} | {i: 80 for i in range(80, 101)}


def test_hot_keys_are_broadcast_once(spark):
    left = spark.range(1000).selectExpr("if(id < 900, 7, id) as k", "id as x").unionByName(spark.createDataFrame([(None, 1)], "k long, x long"))
    right = left.filter("k is not null").groupBy("k").count().withColumn("y", F.col("k") * 2)
    got = common.attach(left, right, "k", "count", 1001)
    assert got.columns == ["k", "x", "count", "y"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, left.join(right, "k").collect()))
    assert sorted(map(tuple, common.attach(left, right, "k", "count", 1001, "left").collect()), key=str) == sorted(map(tuple, left.join(right, "k", "left").collect()), key=str)
    build = [line.split("HashAggregate")[0] for line in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "rightHint=(strategy=broadcast)" in line]
    assert len(build) == 2  # once for hot rows, once for the others; Spark reuses the exchange, as both are the same
