"""The pipeline's stages, and queries against their SQL."""

import re
import zlib

import numpy as np
import pytest
import test_near
import test_quality
from helpers import SMALL, canonical

import corpus_pipeline
from docmill.llm import classifier, packing, queries, weak


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query(spark, oracle, name):
    assert canonical(queries.QUERIES[name](spark, SMALL).toPandas()) == canonical(oracle.execute(queries.ORACLE_SQL[name]).df())


def test_stages_keep_columns_and_only_drop(docs, spark):
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, SMALL)
        assert out.columns == docs.columns, name
        assert out.count() <= now.count()
        now = out
    last = corpus_pipeline.STAGES[-1][1](spark, now, SMALL)
    assert {r.doc_id for r in last.select("doc_id").collect()} == {r.doc_id for r in now.collect()}


def test_stages_on_an_empty_table(none, spark):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SMALL).count() == 0


def test_run(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    rows = corpus_pipeline.run(spark, SMALL).collect()
    kept = {r.doc_id for r in rows}
    assert not [i for i in kept if labels.get(i) == 0]
    by = {}
    for r in rows:
        by[r.sequence_id] = by.get(r.sequence_id, 0) + r.length
    assert max(by.values()) <= 2048 and len(by) <= -(-sum(by.values()) // 2048) + 1
    assert packing.GROUP > 0


def test_discarded_tables_are_gone(spark):
    """Only staged tables can be discarded, each once; others stay."""
    from docmill.llm import common

    a, b = common.stage(spark.range(5).toDF("x"), "test-a"), common.stage(spark.range(6).toDF("x"), "test-b")
    path = a.inputFiles()[0].rpartition("/")[0]
    common.discard(a)
    assert b.count() == 6
    with pytest.raises(Exception, match="(?i)not.exist|found|no such"):
        spark.read.parquet(path).count()
    with pytest.raises(KeyError):
        common.discard(a)


def rule_votes(t):
    """Votes of the six rules, by their definitions."""
    words, chars, symbols, dup, rep, _ = test_quality.brute(t)
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = len([x for x in t.split("\n") if x.strip(" \t\x0b\x0c\r")])
    capitals = sum("A" <= c <= "Z" for c in t)
    distinct = sum(len(set(w[i : i + 3000])) for i in range(0, words, 3000))

    def vote(bad, good, silent=False):
        return weak.ABSTAIN if silent or not words else weak.BAD if bad else weak.GOOD if good else weak.ABSTAIN

    return [
        vote(100 * symbols > 4 * chars, 100 * symbols < chars), vote(dup >= 3 and 100 * dup > 25 * lines, 100 * dup < 10 * lines, lines < 3),
        vote(100 * rep > 50 * words, 100 * rep < 25 * words, words < 50), vote(chars < 2 * words or 10 * chars > 90 * words, 35 * words < 10 * chars < 75 * words),
        vote(100 * capitals > 40 * chars, 100 * capitals < 15 * chars), vote(100 * distinct < 25 * words, 100 * distinct > 45 * words, words < 50),
    ]


def test_run_by_brute_force(spark):
    """Every stage over the whole table, one document at a time; the pieces of what stays, by the library itself."""
    import public_tokenizers as P
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    w, b = classifier.train(docs)
    now = [(r.doc_id, r.text or "") for r in docs.collect()]
    n_all = len(now)
    now = [(i, t) for i, t in now if 1 / (1 + np.exp(-(float(classifier.features(t, classifier.measures(t)[1]) @ w) + b))) >= classifier.THRESHOLD]
    bad = test_quality.brute_posteriors([rule_votes(t) for _, t in now])
    now = [(i, t) for (i, t), p in zip(now, bad, strict=True) if not test_quality.brute(t)[5] and p <= 0.5]
    first = {}
    for i, t in sorted(now):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), (i, t))
    now = sorted(first.values())
    stays = {i for i, least, _ in test_near.brute(now) if i == least}
    now = [(i, t) for i, t in now if i in stays]
    assert 0 < len(now) < n_all
    tokenizer, want = Tokenizer.from_file(P.path("word_bpe_49k.json")), []
    for i, t in now:
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 0]
        want += [(i, s // 2048, s, len(ids[s : s + 2048]), zlib.crc32(np.array(ids[s : s + 2048], "<u4").tobytes())) for s in range(0, len(ids), 2048)]
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 2048
