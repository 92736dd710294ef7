"""Classifier and voting rules: held-out labels, brute-force measures, clean corpora."""

import re
from collections import Counter

import numpy as np
from helpers import SMALL

from docmill.llm import classifier, rules, weak


def brute(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    c = Counter(zip(w, w[1:], w[2:]))
    rep = {j for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(rep), len(w) < 50 or 100 * len(rep) > 50 * len(w)


def test_measures(docs, spark):
    some = docs.unionByName(docs.selectExpr("doc_id", "'a b c a b c' AS text", "uid", "shard", "kept", "score", "_uid", "rep").limit(1)).unionByName(docs.selectExpr("doc_id", "'x x x x\n\n y \n y \nx x x x' AS text", "uid", "shard", "kept", "score", "_uid", "rep").limit(1))
    for r in rules.judge(rules.measure(some.drop("kept")).cache()).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(r.text)
        assert not (r.base_failed and r.kept)


def test_empty(none, spark):
    assert rules.judge(rules.measure(none.select("doc_id", "text"))).count() == 0
    w, b = classifier.train(none)
    assert classifier.score(none, w, b, "s").count() == 0


def test_rules_on_labels(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").withColumnRenamed("quality", "label")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").join(labels, "doc_id")
    got = rules.judge(rules.measure(docs).drop("text").cache()).collect()
    assert np.mean([r.kept for r in got if r.label == 1 and not r.base_failed]) >= 0.99
    assert np.mean([not r.kept for r in got if r.label == 0]) >= 0.95


def test_classifier_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    w, b = classifier.train(docs)  # labels play no part
    scored = classifier.score(docs.select("doc_id", "text"), w, b, "s").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").collect()
    kept = [r.s >= classifier.THRESHOLD for r in scored if r.quality == 1]
    out = [r.s < classifier.THRESHOLD for r in scored if r.quality == 0]
    assert np.mean(kept) >= 0.99 and np.mean(out) >= 0.95


def test_clean_documents_stay(spark):
    """A corpus without junk: no class of bad documents is made up."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").join(spark.read.parquet(f"{SMALL}/labels.parquet").filter("quality = 1").select("doc_id"), "doc_id")
    w, b = classifier.train(docs)
    assert classifier.score(docs, w, b, "s").filter(f"s < {classifier.THRESHOLD}").count() == 0
    got = rules.judge(rules.measure(docs).cache()).filter("not base_failed")
    assert got.filter("not kept").count() <= 0.01 * got.count()


def test_score_keeps_columns(docs):
    w, b = classifier.train(docs)
    got = classifier.score(docs, w, b, "probability")
    assert got.columns == [*docs.columns, "probability"] and got.count() == docs.count()


def test_expectation_maximisation_finds_accuracies():
    rng = np.random.default_rng(5)
    bad = rng.random(20000) < 0.2
    hit, clear = np.array([0.9, 0.6, 0.4]), np.array([0.999, 0.9985, 0.999])
    votes = np.where(bad[:, None], rng.random((20000, 3)) < hit, rng.random((20000, 3)) > clear).astype(int)
    votes[rng.random((20000, 3)) < 0.2] = weak.ABSTAIN
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    trust = weak.fit(patterns, counts.astype(float))
    assert np.abs(trust.hit - hit).max() < 0.05 and abs(trust.share - 0.2) < 0.03
    assert np.mean((trust.posterior(votes) > 0.5) == bad) > 0.93


def test_column_and_array_agree(spark):
    trust = weak.fit(np.array([[1, 0], [0, 0], [-1, 1]]), np.array([5.0, 90.0, 3.0]))
    votes = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1)]
    from pyspark.sql import functions as F

    got = [r.p for r in spark.createDataFrame(votes, "a int, b int").select(trust.column([F.col("a"), F.col("b")]).alias("p")).collect()]
    assert np.allclose(got, trust.posterior(np.array(votes)))


def test_exact_word_counts():
    """Long texts without words have no votes, those of a few huge words none of the labellers that need words."""
    assert set(classifier.votes(*classifier.measures(" \n" * 1000))) == {weak.ABSTAIN}
    got = dict(zip(classifier.LABELLERS, classifier.votes(*classifier.measures("x" * 3000 + " " + "y" * 3000)), strict=True))
    assert got["repeats"] == got["commonest"] == got["sameness"] == weak.ABSTAIN and got["length"] == weak.BAD


def test_variety_of_long_texts(spark):
    """Shuffled filler is judged alike on both sides of a window's end and far beyond, and so are varied texts."""
    rng = np.random.default_rng(3)
    sizes = (2999, 3000, 3001, 9001)
    for pool, vote in ((100, weak.BAD), (20000, weak.GOOD)):
        texts = [" ".join(f"w{i}" for i in rng.integers(0, pool, n)) for n in sizes]
        assert {classifier.votes(*classifier.measures(t))[list(classifier.LABELLERS).index("sameness")] for t in texts} == {vote}
        rows = rules.vote(rules.measure(spark.createDataFrame([(t,) for t in texts], "text string")).cache()).collect()
        for r in rows:
            w = r.text.split()
            assert r.n_distinct_words == sum(len(set(w[i : i + 3000])) for i in range(0, len(w), 3000)) and r.vote_variety == vote


def test_sample_is_packed():
    """The scorer has its full sizes, and what the driver collects of a text is small and loses only float16's rounding."""
    assert (classifier.SAMPLE, classifier.SHAPES, classifier.STEPS) == (6000, 1024, 256)
    for text in ("", "Hello, World! 123\n" * 40, "x"):
        x = classifier.features(text, classifier.measures(text)[1])
        data = classifier.packed(x)
        assert len(data) == 4 * np.count_nonzero(x) and np.array_equal(classifier.unpacked(data), x.astype(np.float16).astype(np.float32))


def planted(hit, clear, n=20000, share=0.2, seed=5):
    rng = np.random.default_rng(seed)
    bad = rng.random(n) < share
    votes = np.where(bad[:, None], rng.random((n, len(hit))) < hit, rng.random((n, len(hit))) > clear).astype(int)
    votes[rng.random(votes.shape) < 0.2] = weak.ABSTAIN
    return bad, votes


def test_false_alarms_are_estimated():
    """Rates from 0.001 to 0.1, each found from agreement alone."""
    for hit, clear in (((0.9, 0.7, 0.8, 0.6), (0.98, 0.9, 0.99, 0.999)), ((0.9, 0.8, 0.7, 0.8, 0.6), (0.98, 0.9, 0.98, 0.999, 0.9))):
        bad, votes = planted(np.array(hit), np.array(clear))
        patterns, counts = np.unique(votes, axis=0, return_counts=True)
        trust = weak.fit(patterns, counts.astype(float))
        assert np.abs(trust.alarms - (1 - np.array(clear))).max() < 0.015
        assert np.abs(trust.hit - hit).max() < 0.07 and abs(trust.share - 0.2) < 0.03
        assert np.mean((trust.posterior(votes) > 0.5) == bad) > 0.97


def test_a_defect_that_one_voter_sees_is_no_false_alarm():
    """Kinds that exclude one another, each seen by voters of its own: the lonely one counts as much as the others."""
    rng = np.random.default_rng(3)
    kind = rng.choice(4, 20000, p=[0.85, 0.07, 0.05, 0.03])
    seen = np.array([[0, 0, 0, 0], [1, 0, 0, 0], [0, 0.9, 0.8, 0], [0, 0, 0.7, 0.9]])
    votes = (rng.random((20000, 4)) < seen[kind]).astype(int)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    trust = weak.fit(patterns, counts.astype(float))
    assert trust.alarms.max() < 0.005
    assert np.mean((trust.posterior(votes) > 0.5) == (kind > 0)) > 0.98


def test_fit_without_rows():
    """The priors decide."""
    trust = weak.fit(np.zeros((0, 3), int), np.zeros(0))
    assert abs(trust.share - 0.1) < 1e-6 and np.allclose(trust.alarms, 0.005) and trust.posterior(np.full((1, 3), weak.ABSTAIN))[0] < 0.5


def brute_posteriors(rows):
    """Fit by one document at a time, with each class's likelihood multiplied out."""
    trust = weak.fit(*[x.astype(t) for x, t in zip(np.unique(np.array(rows), axis=0, return_counts=True), (int, float), strict=True)])
    out = []
    for votes in rows:
        classes = []
        for share, sees in [(1 - trust.share, [0] * len(votes)), *zip(trust.kinds, trust.sees, strict=True)]:
            chance = share
            for v, s, a in zip(votes, sees, trust.alarms, strict=True):
                bad = a + s - a * s
                chance *= {weak.BAD: bad, weak.GOOD: 1 - bad, weak.ABSTAIN: 1}[v]
            classes.append(chance)
        out.append(sum(classes[1:]) / sum(classes))
    return out


def brute_labels(t):
    """Measures and votes of the labellers, by their definitions."""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not w:
        return [weak.ABSTAIN] * 7
    chars = len("".join(w))
    capitals = sum(c != c.lower() for c in t) if len(t.lower()) == len(t) else sum(c.isupper() for c in t)
    measures = {
        "symbols": len(re.findall(r"[#*$%&|<>]", t)) / chars, "capitals": capitals / chars, "repeats": sum(a == b for a, b in zip(w, w[1:])) / len(w), "commonest": max(Counter(w).values()) / len(w),
        "sameness": sum(w[i] in w[i - i % 3000 : i] for i in range(len(w))) / len(w), "shouts": t.count("!!") / len(w), "length": chars / len(w),
    }
    out = []
    for name, (bad, good) in classifier.LABELLERS.items():
        few = name in ("repeats", "commonest", "sameness") and len(w) < classifier.ENOUGH
        out.append(weak.ABSTAIN if few else weak.BAD if measures[name] > bad else weak.GOOD if measures[name] < good else weak.ABSTAIN)
    return out


def test_labels_and_posteriors_by_brute_force(spark):
    """Every document of the table: measures, votes, and the posteriors that the scorer learns from."""
    texts = [r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    texts = [t if len(t) < 30000 else t[:30000] for t in texts] + ["", " \n", "A B", "!!" * 30, "x " * 40, "Straße İİ " * 30]
    want = [brute_labels(t) for t in texts]
    assert [classifier.votes(*classifier.measures(t)) for t in texts] == want
    patterns, counts = np.unique(np.array(want), axis=0, return_counts=True)
    assert np.allclose(weak.fit(patterns, counts.astype(float)).posterior(np.array(want)), brute_posteriors(want))


def test_verdicts_of_rules_by_brute_force(spark):
    """Quality and verdict of every document, from its votes by multiplication."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    rows = rules.judge(rules.measure(docs).cache()).collect()
    bad = brute_posteriors([[r[v] for v in rules.RULES] for r in rows])
    assert np.allclose([1 - r.quality for r in rows], bad)
    assert [r.kept for r in rows] == [not r.base_failed and 1 - b >= 0.5 for r, b in zip(rows, bad, strict=True)]


def test_clashing_columns_are_kept(docs, none):
    """Columns of documents with the names of results come back under another name, and change nothing."""
    from pyspark.sql import functions as F

    odd = docs.select("doc_id", "text", F.lit("k").alias("kept"), F.lit("K").alias("Quality"), F.lit("w").alias("_words"), F.lit(7).alias("n_words"), F.lit(8).alias("n_words_"))
    got = rules.judge(rules.measure(odd).cache())
    assert got.columns[:7] == ["doc_id", "text", "kept_", "Quality_", "_words_", "n_words_", "n_words__"]
    plain = {(r.doc_id, r.text): (r.n_words, r.quality, r.kept) for r in rules.judge(rules.measure(docs.select("doc_id", "text")).cache()).collect()}
    for r in got.collect():
        assert (r.n_words, r.quality, r.kept) == plain[r.doc_id, r.text] and (r.kept_, r.Quality_, r._words_, r.n_words_, r.n_words__) == ("k", "K", "w", 7, 8)
    assert rules.judge(rules.measure(odd.filter("false"))).count() == 0


def brute_features(text):
    """The scorer's features of a whole text, one triple of characters and one measure at a time."""
    kinds = []
    for b in text.encode():
        c = chr(b)
        kinds.append(1 if b >= 128 or "a" <= c <= "z" else 2 if "A" <= c <= "Z" else 3 if "0" <= c <= "9" else b)
    counts = Counter(((a << 16 | b << 8 | c) * 0x9E3779B1 % 2**32) >> 22 for a, b, c in zip(kinds, kinds[1:], kinds[2:]))
    out = {k: float(np.float16(np.float32((n / (len(kinds) - 2)) ** 0.5))) for k, n in counts.items()}
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    n, chars = len(w), len("".join(w))
    capitals = sum(c != c.lower() for c in text) if len(text.lower()) == len(text) else sum(c.isupper() for c in text)
    measures = [0.0] * 7 if not n else [
        len(re.findall(r"[#*$%&|<>]", text)) / chars, capitals / chars, sum(a == b for a, b in zip(w, w[1:])) / n, max(Counter(w).values()) / n,
        1 - sum(len(set(w[i : i + 3000])) for i in range(0, n, 3000)) / n, text.count("!!") / n, chars / n,
    ]
    for j, v in enumerate(measures):
        step = min(15, int(np.log2(1 + 1000 * v)))
        out[1024 + (j * 0x9E3779B1 + step * 0x85EBCA6B) % 256] = 1.0
    return out


def test_scores_by_an_independent_fit(spark):
    """Whole texts through the query, against labels, posteriors, features and gradient steps written out one by one."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    texts = [r.text or "" for r in docs]
    bad = brute_posteriors([brute_labels(t) for t in texts])
    distinct = {t: b for t, b in zip(texts, bad, strict=True)}  # so few that all are drawn
    x, y = [brute_features(t) for t in distinct], [1 - b for b in distinct.values()]
    good = sum(v > 0.5 for v in y)
    weight = [0.5 / good if v > 0.5 else 0.5 / (len(y) - good) for v in y]
    w, b, dw, db = np.zeros(1280), 0.0, np.zeros(1280), 0.0
    for _ in range(300):
        step, shift = np.zeros(1280), 0.0
        for f, v, s in zip(x, y, weight, strict=True):
            off = (1 / (1 + np.exp(-(sum(w[k] * z for k, z in f.items()) + b))) - v) * s
            for k, z in f.items():
                step[k] += off * z
            shift += off
        dw, db = 0.9 * dw - 2.0 * (step + 1e-4 * w), 0.9 * db - 2.0 * shift
        w, b = w + dw, b + db
    want = {r.doc_id: 1 / (1 + np.exp(-(sum(w[k] * z for k, z in brute_features(t).items()) + b))) for r, t in zip(docs, texts, strict=True)}
    got = classifier.op4_weak_label(spark, SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        assert abs(r.score - want[r.doc_id]) < 2e-3
        assert r.kept == (r.score >= classifier.THRESHOLD)
