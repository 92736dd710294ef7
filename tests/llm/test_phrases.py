"""Phrase mining against brute force."""

import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from docmill.llm import phrases

SCHEMA = "doc_id long, text string, lang string, phrase string, n long, score double, words string"
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def docs_of(spark):
    """Nulls, empty and very long texts, ties, repeats, odd characters, and columns with clashing names."""
    long = " ".join(f"word{i % 37} of the {'x' * (i % 5)} sea." if i % 11 else "over and\tover and over" for i in range(6000))
    texts = [(1, long, "en"), (2, None, "en"), (3, "", None), (4, "the the the the the the the", "en"), (5, "ÀÉ À.É\x0bé;A B\rC d", None), (6, "one two one two", "und"), (7, "\x00 a\x85b \x1f c", "de")]
    texts += [(10 + i, "Copies of one text, copies of one text: the end of it!", "fr") for i in range(30)] + [(None, "and then, and then and then", "en"), (1, long, "en"), (8, "z", "xx"), (9, " \t ", "yy")]
    texts += [(100 + i, f"north sea route {i % 3} north sea", "en") for i in range(40)]
    return [(*t, "p", 1, 2.0, "w") for t in texts]


def brute(rows, least, shown):
    n, f = Counter(), defaultdict(Counter)
    for _, text, lang, *_ in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(UPPER)):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, 6):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        frequent = {p: a for p, a in counts.items() if a >= least}
        closed = set()
        for p, a in frequent.items():
            for m in range(2, len(p)):
                closed.update(p[i : i + m] for i in range(len(p) - m + 1) if 100 * a >= 100 * counts[p[i : i + m]])
        found = []
        for p, a in frequent.items():
            if len(p) > 1 and p not in closed:
                score, _, l, r = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                found.append((" ".join(p), a, l, r, n[lang], score))
        found.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        out += [(lang, i, *x) for i, x in enumerate(found[:shown], 1)]
    return sorted(out)


@pytest.mark.parametrize(("mean", "bits", "piece"), [(2, 25, 1 << 23), (24, 8, 4000)])
def test_phrases_are_those_of_brute_force(spark, monkeypatch, mean, bits, piece):
    """Also with many cuts, or with filters that are full and slices of few texts."""
    monkeypatch.setattr(phrases, "MEAN", mean)
    monkeypatch.setattr(phrases, "FILTER_BITS", bits)
    monkeypatch.setattr(phrases, "SLICE", piece)
    rows = docs_of(spark)
    found = phrases.collocations(spark.createDataFrame(rows, SCHEMA).repartition(3), least=5, shown=40)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == brute(rows, 5, 40)


def test_of_nothing(spark):
    assert phrases.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert phrases.collocations(spark.createDataFrame([(1, None, None, "p", 1, 2.0, "w")], SCHEMA)).count() == 0


def test_copies_are_one_set_of_chunks(spark):
    """The dictionary of a text and of a thousand copies has the same chunks; each word is owned once."""
    text = " ".join(f"w{i * 7919 % 613}" + ("." if i % 17 == 0 else "") for i in range(3000))
    one = phrases.dictionary(spark.createDataFrame([(text, "en")], "text string, lang string")).toPandas()
    many = phrases.dictionary(spark.createDataFrame([(text, "en")] * 1000, "text string, lang string")).toPandas()
    assert len(one) == len(many) and set(one.chunk) == set(many.chunk)
    assert (one.owned * one.n).sum() == 3000 and (many.owned * many.n).sum() == 3_000_000


def test_cuts_depend_on_content_alone():
    text = " ".join(f"w{i * 7919 % 613}" for i in range(3000))

    def chunks(t):
        return set(pa.Table.from_batches(phrases.parse([pa.record_batch([pa.array(["en"]), pa.array([t])], ["lang", "text"])])).column("chunk").to_pylist())

    assert len(chunks(text) & chunks("other words before " + text)) > 0.9 * len(chunks(text))


def test_products_beyond_64_bits(spark):
    """Counts of a large corpus: 1000 a n and l r pass 64 bits."""
    a, n, l, r = 3 * 10**12, 10**15, 7 * 10**12, 5 * 10**12
    row = spark.createDataFrame([(a, n, l, r)], "a long, n long, l long, r long")
    assert row.select(phrases.score().alias("s")).first().s == 1000 * a * n // (l * r)
