"""Exact top-k search and vector codes against brute force."""

import hashlib
import math

import numpy as np
import pytest
from docmill.llm import codes, topk
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<double>, label string, uid string, x double, norm string, score string"


def rows_of(seed=7, n=400, dims=24):
    """Random vectors with ties, repeated rows, repeated and null ids, ragged and empty vectors, and rows that take no part."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dims)) * rng.exponential(size=(n, 1))
    rows = [(i, v.tolist(), f"l{i % 5}") for i, v in enumerate(base)]
    hot = base[3].tolist()
    rows += [(1000 + i, hot, "hot") for i in range(n // 2)]  # a third of all rows are equal
    rows += [(50, base[1].tolist(), None), (50, base[1].tolist(), None), (None, base[2].tolist(), "l1"), (7, [], "l2"), (8, base[4].tolist()[:5], "l2"), (100, [0.0] * dims, "z")]
    rows += [(150, None, "l1"), (151, [1.0, None], "l1"), (200, [float("nan")] * dims, "l1"), (201, [float("inf")] + [0.0] * (dims - 1), None)]
    return [(*r, "u", 1.0, "n", "s") for r in rows]


def whole(rows, scale):
    out = []
    for r in rows:
        v = r[1]
        if v is not None and all(c is not None and math.isfinite(c) for c in v):
            out.append((r[0], [math.floor(scale * c) for c in v], r[2]))
    return out


def brute_top(rows, k, scale):
    kept, out = whole(rows, scale), []
    for i, (q, v, _) in enumerate(kept):
        if q is None or q % 50:
            continue
        scored = [(sum(a * b for a, b in zip(v, w, strict=False)), c) for j, (c, w, _) in enumerate(kept) if j != i]
        scored.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        out += [(q, n, c, s) for n, (s, c) in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [16, 1024])
def test_top_k_is_that_of_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "SEEDS", 20)
    monkeypatch.setattr(topk, "BUCKET", 100)
    rows = rows_of()
    found = topk.top_k(spark.createDataFrame(rows, SCHEMA), F.col("id") % 50 == 0)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == brute_top(rows, 5, 256)


def test_top_k_beyond_doubles(spark):
    """Scores that float64 doesn't hold are exact."""
    rows = [(i, [float(2**28 + i), float(i % 7)], "a", "u", 1.0, "n", "s") for i in range(120)]
    found = topk.top_k(spark.createDataFrame(rows, SCHEMA), F.col("id") % 50 == 0, scale=2)
    assert sorted(map(tuple, found.collect()), key=str) == brute_top(rows, 5, 2)


def test_top_k_of_few_rows(spark):
    table = spark.createDataFrame(rows_of(), SCHEMA)
    assert topk.top_k(table.filter("false"), F.col("id") % 50 == 0).count() == 0
    assert topk.top_k(table.filter("vec_id = 250"), F.col("id") % 50 == 0).count() == 0
    assert topk.top_k(table.filter("vec_id in (250, 3)"), F.col("id") % 50 == 0).count() == 1


def test_bounds_skip_pairs(monkeypatch):
    """Short vectors are never compared, and long tails are cut by their residuals."""
    rng = np.random.default_rng(1)
    x = np.floor(256 * rng.normal(size=(4000, 32)) * rng.exponential(size=(4000, 1)) * (0.7 ** np.arange(32)))
    x = x[np.argsort(-np.linalg.norm(x, axis=1), kind="stable")]
    turn, steps = np.linalg.eigh(x.T @ x)[1][:, ::-1], topk.steps_of(32)
    side = topk.Side(np.arange(4000), x, turn, steps)
    asked = topk.Side(np.arange(0, 4000, 50), x[::50], turn, steps)
    compared = []
    plain = topk.exact_scores
    monkeypatch.setattr(topk, "exact_scores", lambda a, b, bound: (compared.append(len(a) * len(b)), plain(a, b, bound))[1])
    best = topk.Best(80, 5, np.full(80, -np.inf))
    topk.search(asked, side, np.arange(4000), np.zeros(4000, bool), best, steps)
    scores = asked.x @ x.T
    scores[np.arange(80), np.arange(0, 4000, 50)] = -np.inf
    want = np.sort(scores, axis=1)[:, ::-1][:, :5]
    assert (best.score.reshape(80, 5) == want).all()
    assert sum(compared) < 0.6 * 80 * 4000


def brute_codes(rows):
    kept = whole(rows, codes.SCALE)
    width = -(-max((len(v) for _, v, _ in kept), default=1) // 8) * 8
    x = [v + [0] * (width - len(v)) for _, v, _ in kept]
    p = width // 8
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))[:16]
    books = [[x[i][j * p : (j + 1) * p] for i in order] for j in range(8)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), i) for i, e in enumerate(book))

    for _ in range(6):
        for j, book in enumerate(books):
            mine = [[] for _ in book]
            for v in x:
                mine[nearest(v[j * p : (j + 1) * p], book)[1]].append(v[j * p : (j + 1) * p])
            books[j] = [[sum(c) // len(m) for c in zip(*m, strict=True)] if m else e for m, e in zip(mine, book, strict=True)]
    found = [[nearest(v[j * p : (j + 1) * p], books[j]) for j in range(8)] for v in x]
    errors = [sum(d for d, _ in f) for f in found]
    label = {}
    for (_, _, name), e in zip(kept, errors, strict=True):
        label[name] = label.get(name, 0) + e
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted([(k[0], "".join(f"{i:02x}" for _, i in f), e, label[k[2]], digest) for k, f, e in zip(kept, found, errors, strict=True)], key=str)


@pytest.mark.parametrize("chunk", [60, 2048])
def test_codes_are_those_of_plain_rounds(spark, monkeypatch, chunk):
    monkeypatch.setattr(codes, "CHUNK", chunk)
    monkeypatch.setattr(codes, "LEAF", 5)
    rows = rows_of(seed=3, n=300, dims=19)
    found = codes.compress(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, found.collect()), key=str) == brute_codes(rows)


def test_codes_of_few_rows(spark):
    table = spark.createDataFrame(rows_of(), SCHEMA)
    assert codes.compress(table.filter("false")).count() == 0
    few = [r for r in rows_of() if r[0] in (3, 100, 7)]
    assert sorted(map(tuple, codes.compress(spark.createDataFrame(few, SCHEMA)).collect()), key=str) == brute_codes(few)
    with pytest.raises(Exception, match="a component is beyond"):
        codes.compress(spark.createDataFrame([(1, [1e9], "a", "u", 1.0, "n", "s")], SCHEMA)).count()


def test_balls_hold_their_points_and_give_them_whole():
    rng = np.random.default_rng(5)
    middles = rng.integers(-3000, 3000, (8, 6))
    points = np.concatenate([m + rng.integers(-40, 40, (150, 6)) for m in middles] + [np.tile(middles[0], (400, 1))])
    tree = codes.Balls(points)
    assert sorted(tree.order.tolist()) == list(range(len(points)))
    held = points[tree.order]
    for left, start, stop, c, r, s in zip(tree.left, tree.start, tree.stop, tree.centre, tree.radius, tree.sums, strict=True):
        assert np.linalg.norm(held[start:stop] - c, axis=1).max() <= r + 1e-9
        assert (held[start:stop].sum(0) == s).all()
        assert left >= 0 or stop - start <= codes.LEAF or r == 0
    named = {k: getattr(tree, k) for k in ("centre", "radius", "sums", "left", "right", "start", "stop")}
    code, sums, counts, single = codes.assign(named, held, middles)
    want = codes.distances(held, middles).argmin(1)
    assert (code == want).all() and (counts == np.bincount(want, minlength=8)).all()
    assert (sums == np.stack([held[want == e].sum(0) for e in range(8)])).all()
    assert single < len(points) / 4  # most balls are owned whole


def test_large_components_are_exact():
    a, b = np.array([[2**27, -(2**27)]]), np.array([[2**27 - 1, 2**27], [2**27, -(2**27)]])
    assert codes.distances(a, b).tolist() == [[1 + 2**56, 0]]
