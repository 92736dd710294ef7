"""What keeps jobs within their limits as tables grow: partitions by size, no broadcast of ids, one sort, packed files."""

import gzip

import duckdb
import pytest
from helpers import SMALL
from pyspark.sql import functions as F

from docmill.functions.calculated import calc
from docmill.operators import reconcile, shred, sinks
from docmill.plans import fanout
from docmill.queries import ORACLE, QUERIES, contracts, fanouts, shredding
from docmill.queries.base import Tables
from docmill.sources import documents, staging


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_documents_are_what_to_xml_writes(spark):
    rows = spark.createDataFrame([("a<b>&\"'\n\r\tc", 1), ("", 2), (None, None)], "t string, n long")
    struct = F.struct(F.struct(F.col("t").alias("_t"), F.col("n").alias("_n"), F.struct(F.col("n").alias("_k")).alias("y")).alias("x"))
    own = shredding.tag(1, "x", {"t": shredding.escaped(F.col("t")), "n": F.col("n").cast("string")}, shredding.tag(2, "y", {"k": F.col("n").cast("string")}))
    got = rows.select(F.to_xml(struct, {"rowTag": "r"}).alias("a"), F.concat(F.lit("<r>"), own, F.lit("\n</r>")).alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got]


def test_building_documents_sorts_lines_once_in_partitions_by_size(spark, monkeypatch):
    monkeypatch.setattr(staging, "PART_BYTES", 1 << 12)
    with staging.grouped_by_sort(spark):
        text = plan(shredding.build(Tables(spark, SMALL)))
    assert "ObjectHashAggregate" not in text and "Window" not in text and "BroadcastHashJoin" not in text
    assert text.count("Sort [l_orderkey") == 1 and "REPARTITION_BY_NUM" in text


def test_lines_are_sorted_behind_their_shuffle_only(spark):
    """Also where the default number of partitions is enough: a map task's share of a large file would not fit into its memory."""
    with staging.grouped_by_sort(spark):
        text = plan(shredding.build(Tables(spark, SMALL)))
    after = text[text.index("Sort [l_orderkey") :].splitlines()
    assert text.count("Sort [l_orderkey") == 1 and "Exchange hashpartitioning(l_orderkey" in after[1]
    assert "transform(" not in text  # lambdas are interpreted


def test_parsers_build_what_a_query_takes(spark):
    small = shred.pruned(shredding.WIDE, "Request._Status", f"{shredding.CONTACTS}._con_id")
    assert small.simpleString() == "struct<Request:struct<_Status:string,CustData:struct<application:struct<contact:array<struct<_con_id:string>>>>>>"
    assert shred.pruned(shredding.WIDE, "Request") == shredding.WIDE
    assert contracts.CONTRACT.schema("indicators").simpleString() == "struct<Request:struct<CustData:struct<application:struct<_signature_ind:string>>>>"
    assert "_ac_role" in contracts.CONTRACT.schema("picked").simpleString() and "_score_a" not in contracts.CONTRACT.schema("picked").simpleString()
    assert "_con_id:string>" in shredding.shredded(Tables(spark, SMALL), f"{shredding.CONTACTS}._con_id").schema.simpleString()
    assert shredding.contacts(Tables(spark, SMALL), "con_id", "role").columns == ["doc_id", "contact_pos", "con_id", "role"]


def test_partitions_grow_with_the_table_and_rows_stay(spark, monkeypatch, tmp_path):
    spark.range(1000).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    assert staging.spread(df, "id").rdd.getNumPartitions() == df.rdd.getNumPartitions()
    monkeypatch.setattr(staging, "PART_BYTES", 256)
    wide = staging.spread(df, "id")
    assert wide.rdd.getNumPartitions() > 4 and wide.count() == 1000
    local = spark.createDataFrame(spark.sparkContext.parallelize([(1,)]), "id long")
    assert staging.spread(local, "id").count() == 1


def test_ids_are_not_broadcast(spark, tmp_path):
    ids = spark.range(10).withColumnRenamed("id", "doc_id")
    log = ids.filter("doc_id < 5").withColumn("status", F.lit("success"))
    left = documents.unprocessed(ids, log)
    assert "Broadcast" not in plan(left) and sorted(r.doc_id for r in left.collect()) == [5, 6, 7, 8, 9]
    none = ids.filter("doc_id = 9").withColumns({"stage": F.lit("mapping"), "message": F.lit("m")})
    sinks.commit_documents({"t": ids}, none, sinks.log_outcomes(ids.filter("doc_id < 9"), none, "s"), ["t"], str(tmp_path))
    seen = sinks.visible(spark, str(tmp_path), "t")
    assert "Broadcast" not in plan(seen) and seen.count() == 9


def test_sides_are_sorted_behind_their_shuffle_only(spark, monkeypatch):
    monkeypatch.setattr(staging, "PART_BYTES", 8)
    a = spark.range(9).selectExpr("id as k", "cast(id as string) as v")
    one = reconcile._sides({"a": (a, ["v"]), "b": (a.filter("k < 4").withColumnRenamed("v", "w"), ["w"])}, ["k"])
    assert plan(one).count("Exchange") == 1 and one.count() == 9 and one.filter("w is not null").count() == 4


def test_parties_are_shuffled_with_what_is_mapped_only(spark, monkeypatch):
    docs = shredding.documents(Tables(spark, SMALL))
    want = sorted(map(tuple, fanout.fan_out(docs, fanouts.CONTRACT).tables["contact_base"].collect()))
    monkeypatch.setattr(staging, "PART_BYTES", 1 << 10)
    made = fanout.fan_out(docs, fanouts.CONTRACT).tables["contact_base"]
    shuffled = next(line for line in plan(made).splitlines() if "REPARTITION_BY_NUM" in line)
    below = plan(made).split(shuffled)[1].splitlines()[1]
    assert "contact_address" not in below and sorted(map(tuple, made.collect())) == want


def test_tables_are_mapped_once_for_their_order(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(fanouts, "fan_out", lambda *a: calls.append(1) or fanout.fan_out(*a))
    assert fanouts.fanout_order(Tables(spark, SMALL)).count() == 4 and len(calls) == 1


def test_packed_files_of_documents(spark, tmp_path):
    text = '<Envelope><Request ID="1" n="é"/></Envelope>\n<Envelope><Request ID="2"/></Envelope>\n'
    (tmp_path / "a.xml.gz").write_bytes(gzip.compress(text.encode("cp1252")))
    (tmp_path / "b.xml").write_bytes(text.replace("1", "3").replace("2", "4").encode())
    rows = documents.read_xml_dir(spark, f"{tmp_path}/*", root="Envelope").collect()
    assert sorted((r.doc_id, "é" in r.xml) for r in rows) == [(1, True), (2, False), (3, True), (4, False)]


@pytest.mark.parametrize("text", ["<a/>", "﻿\r\n<a>\r\n</a>\r ", "ï»¿﻿\x01<a/>\x0b", " \x01<a/>", "", None, "\r<a>\rx", "x﻿<a/>", "\x01﻿<a/>", " <a/> "])
def test_clean_xml_is_the_patterns(spark, text):
    c = F.col("x")
    for pattern, to in (("^(﻿|ï»¿)+", ""), (r"^[\x00-\x08\x0B\x0C\x0E-\x1F]+", ""), (r"\r\n?", "\n"), (r"^\s+|\s+$", "")):
        c = F.regexp_replace(c, pattern, to)
    r = spark.createDataFrame([(text,)], "x string").select(c.alias("a"), shred.clean_xml(F.col("x")).alias("b")).first()
    assert r.a == r.b


def test_days_beyond_the_calendar(spark):
    ids = [0, 1, 2925592, 2925593, 2925594, 9_000_000, 3_000_000_000, -726467, -726468, -726469, -726470]
    got = spark.createDataFrame([(i,) for i in ids], "id long").select("id", calc("DATEADD(day, id, DATE('1990-01-01'))", lambda n: F.col(n).cast("string")).alias("out")).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE orders AS SELECT unnest(?)::BIGINT AS o_orderkey, 1 AS o_custkey, 'F' AS o_orderstatus, '1' AS o_orderpriority, 1.0 AS o_totalprice, DATE '1995-01-01' AS o_orderdate", [ids])
    assert sorted(map(tuple, got)) == sorted(con.execute(ORACLE["calc_dateadd"]).fetchall())
