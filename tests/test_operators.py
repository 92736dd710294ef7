"""Operators on small tables: nulls, ties, empty input."""

from pyspark.sql import functions as F

from docmill.operators import paging, pick, quality, reconcile, relate, shred, sinks, summarize
from docmill.sources import documents as d


def test_read_xml_dir(spark, tmp_path):
    (tmp_path / "a.xml").write_bytes('<E><Request ID="5"/>é</E>'.encode())
    (tmp_path / "b.xml").write_bytes('<E><Request ID="6"/>é</E>'.encode("latin-1"))
    rows = d.read_xml_dir(spark, str(tmp_path / "*.xml")).orderBy("doc_id").collect()
    assert [(r.doc_id, "é" in r.xml) for r in rows] == [(5, True), (6, True)]


def test_windows_1252(spark, tmp_path):
    """Quotes, dashes and the euro sign, and U+FFFD for the bytes that the charset leaves undefined."""
    for i, data in enumerate((bytes(range(0x80, 0x100)), "“it’s” – 5 € …".encode("cp1252"), "“€”".encode(), b"\xc3\xa9\x80")):
        (tmp_path / f"{i}.xml").write_bytes(b'<E><Request ID="%d"/>' % i + data + b"</E>")
    got = [r.xml.partition("/>")[2].removesuffix("</E>") for r in d.read_xml_dir(spark, str(tmp_path / "*.xml")).orderBy("doc_id").collect()]
    assert got == [bytes(range(0x80, 0x100)).decode("windows-1252", errors="replace"), "“it’s” – 5 € …", "“€”", "Ã©€"]


def test_decode_bytes_query(spark, tmp_path):
    """The query encodes what Windows-1252 has and the SQL's text comes back, mojibake and unknown characters too."""
    from docmill.queries import QUERIES

    texts = ["“it’s” – 5 € …", "\x80\x81", "Ã©", "日本 “x”", "naïve", "", None, "plain", "Žluťoučký", "Œuvre — 3 ‰"]
    rows = [(2 * i + odd, t) for i, t in enumerate(texts) for odd in (0, 1)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert sorted(map(tuple, QUERIES["decode_bytes"](spark, str(tmp_path)).collect())) == rows
    data = spark.createDataFrame(rows, "doc_id long, text string").select(d.encode_cp1252(F.col("text")).alias("b")).collect()
    known = [t if t in texts[:1] + ["Ã©", "naïve", "", "plain", "Œuvre — 3 ‰"] else None for t in texts]
    assert [None if r.b is None else bytes(r.b) for r in data[::2]] == [None if t is None else t.encode("cp1252") for t in known]


def test_clean(spark):
    row = spark.createDataFrame([("﻿\x01\x02 <a>\r\n</a>\r ",)], "x string")
    assert row.select(shred.clean_xml(F.col("x")).alias("x")).first().x == "<a>\n</a>"


def test_metrics_files(spark, tmp_path):
    (tmp_path / "m1.json").write_text('{\n "run": "a", "items": [{"t": 1.5}]\n}')
    (tmp_path / "n1.json").write_text('{"run": "b"}')
    assert [r.run for r in d.read_metrics(spark, str(tmp_path), "m*.json").collect()] == ["a"]


def test_pages(spark):
    rows = spark.range(10).withColumnRenamed("id", "doc_id")
    assert [r.doc_id for r in d.next_page(rows, None, 2).collect()] == [0, 1]
    assert d.slice_range(rows, None, 3).count() == 4


def test_unprocessed(spark):
    docs = spark.createDataFrame([(1,), (2,), (3,)], "doc_id long")
    log = spark.createDataFrame([(1, "success"), (2, "failed")], "doc_id long, status string")
    assert [r.doc_id for r in d.unprocessed(docs, log).collect()] == [3]
    assert sorted(r.doc_id for r in d.unprocessed(docs, log, retry_failed=True).collect()) == [2, 3]


def test_priority_ties(spark):
    rows = spark.createDataFrame([(1, 7, "N", 0), (1, 7, "A", 1), (1, 7, "A", 2), (1, 8, None, 0)], "app int, con int, role string, pos int")
    got = pick.dedupe_priority(rows, ["app", "con"], "role", ["A", "N"], "pos").orderBy("con").collect()
    assert [(r.con, r.role, r.pos) for r in got] == [(7, "A", 2), (8, None, 0)]


def test_upsert_null_keys(spark):
    stored = spark.createDataFrame([(1, None, "a"), (2, "k", "b")], "id int, k string, v string")
    new = spark.createDataFrame([(1, None, "c", 0), (1, None, "d", 1), (2, "k", None, 2), (3, "k", "e", 3)], "id int, k string, v string, pos int")
    got = sorted((r.id, r.k, r.v) for r in sinks.upsert(new, stored, ["id", "k"], ["v"], "pos").collect())
    assert got == [(1, None, "d"), (2, "k", "b"), (3, "k", "e")]


def test_upsert_empty(spark):
    none = spark.createDataFrame([], "id int, v string")
    assert sinks.upsert(none, none, ["id"], ["v"]).count() == 0


def test_equivalent(spark):
    rows = spark.createDataFrame([("1.00", "1.005"), ("A", "a"), (None, None), ("x", None), ("1", "2")], "a string, b string")
    assert [r.e for r in rows.select(quality.equivalent(F.col("a"), F.col("b")).alias("e")).collect()] == [True, True, True, False, False]


def test_dry_run(spark):
    expected = spark.createDataFrame([(1, "a"), (2, "b")], "id int, k string")
    assert sinks.backfill(expected, expected.filter("id = 1"), ["id"], apply=False).first().would_insert == 1


def test_empty_tables(spark):
    none = spark.createDataFrame([], "app_id long, status string, failure_reason string")
    assert summarize.success_rate(none).first().pct is None
    assert summarize.failures_by_stage(none).count() == 0
    assert reconcile.gap(none, none, none, "app_id").first().gap == 0


def test_failed_documents_stay_unseen(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, v string")
    failed = rows.filter("doc_id = 2").selectExpr("doc_id", "'mapping' AS stage", "'x' AS message")
    log = sinks.log_outcomes(rows.filter("doc_id = 1"), failed, "s")
    sinks.commit_documents({"t": rows}, failed, log, ["t"], str(tmp_path / "out"))
    assert [r.doc_id for r in sinks.visible(spark, str(tmp_path / "out"), "t").collect()] == [1]


def test_stream_dedupe_writes_natural_partitions(spark, tmp_path, monkeypatch):
    """No task writes the whole table; what is sent twice comes out once."""
    from docmill.queries import QUERIES
    from docmill.streaming import incremental

    seen = []
    monkeypatch.setattr(incremental, "stream_dedupe", lambda spark, path, *a, f=incremental.stream_dedupe, **b: (seen.append((len(spark.read.parquet(path).inputFiles()), b)), f(spark, path, *a, **b)))
    spark.range(300).withColumnsRenamed({"id": "o_orderkey"}).withColumn("o_orderstatus", F.lit("F")).repartition(3).write.parquet(str(tmp_path / "orders.parquet"))
    got = sorted(r.doc_id for r in QUERIES["stream_dedupe"](spark, str(tmp_path)).collect())
    assert got == list(range(300)) and seen == [(6, {"files_per_batch": 3})]


def test_require(spark):
    """Blank values get the default; without one the rows go, and are findings."""
    rows = spark.createDataFrame([(1, " a "), (2, " "), (3, None)], "id int, v string")
    good, found = quality.require(rows, "id", "t", "v", "x")
    assert sorted(map(tuple, good.collect())) == [(1, "a"), (2, "x"), (3, "x")] and found.count() == 0
    good, found = quality.require(rows, "id", "t", "v")
    assert list(map(tuple, good.collect())) == [(1, "a")] and sorted(r.doc_id for r in found.collect()) == [2, 3]


def test_audit_defaults(spark):
    rows = spark.createDataFrame([(1, "XX", "1"), (2, "OH", "0"), (3, "OH", "1"), (4, None, None)], "app_id int, state string, zip string")
    log = spark.createDataFrame([(1, "failed"), (3, "success")], "app_id int, status string")
    got = relate.audit_defaults(rows, log, {"state": "XX", "zip": "0"}, "app_id").select("app_id", "status").collect()
    assert sorted((r.app_id, r.status or "-") for r in got) == [(1, "failed"), (2, "-")]


def test_total_of_a_like_table(spark):
    rows = spark.range(7)
    assert {r.total for r in paging.with_total(rows, rows.select("id")).collect()} == {7} == {r.total for r in paging.with_total(rows).collect()}
    assert paging.with_total(rows.filter("false")).count() == 0
