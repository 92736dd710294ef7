"""Whole contracts: order of tables, levels, keys, findings, runs that die, streams."""

import json

import pytest
from pyspark.sql import functions as F

from docmill.operators import sinks
from docmill.plans import fanout
from docmill.plans.contract import Contract, Mapping, Relationship
from docmill.streaming import incremental

APP, PARTY, ADDRESS, PHONE, CARD = "/R/app", "/R/app/party", "/R/app/party/address", "/R/app/party/address/phone", "/R/app/card"


def contract(*more, relationships=None, order=(), filters=None, repeated=(PARTY, ADDRESS, PHONE)):
    mappings = [
        Mapping(APP, "id", "base", "app_id", "bigint", nullable=False), Mapping(PARTY, "id", "party", "con_id", "bigint"), Mapping(PARTY, "name", "party", "name"),
        Mapping(ADDRESS, "zip", "address", "zip"), Mapping(PHONE, "n", "phone", "n"), Mapping(CARD, "no", "card", "no"), *more,
    ]
    links = [
        Relationship("base", "party", "app_id", APP, PARTY), Relationship("party", "address", "con_id", PARTY, ADDRESS), Relationship("base", "address", "app_id", APP, ADDRESS),
        Relationship("address", "phone", "zip", ADDRESS, PHONE), Relationship("base", "card", "app_id", APP, CARD),
    ]
    rules = {PARTY: {"id": True, "role": ["PR", "AU"]}} if filters is None else filters
    return Contract("R", APP, list(repeated), mappings, rules, {"status_enum": {"A": 1}}, {}, list(order), relationships=links if relationships is None else relationships)


DOC = (
    "<R><app id='7'><party id='1' role='PR' name='a'><address zip='z1'><phone n='5'/><phone n='6'/></address><address zip=''><phone n='7'/></address></party>"
    "<party id='1' role='AU' name='b'><address zip='z2'/></party><party id='2' role='AU' name='c'/><party id='2' role='AU' name='d'/><party id='2' role='au' name='x'/><party id='' role='PR' name='e'><address zip='z3'/></party>"
    "<party id='4' role='XX' name='f'><address zip='z4'/></party><card no='9'/></app></R>"
)


def docs(spark, *bodies):
    return spark.createDataFrame(list(enumerate(bodies)), "doc_id long, xml string")


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_levels(spark):
    """Three levels of repeats and a single child; children of elements that a rule drops, or whose parent has no key, are no rows."""
    mapped = fanout.fan_out(docs(spark, DOC, "<R><app id='8'/></R>", "<R><app"), contract())
    t = mapped.tables
    assert list(t) == ["base", "card", "party", "address", "phone"]
    assert rows(t["base"], "doc_id", "app_id") == [(0, 7), (1, 8)]
    assert rows(t["party"], "app_id", "con_id", "name") == [(7, 1, "a"), (7, 2, "d")]  # the preferred role, then the last of equals
    assert rows(t["address"], "app_id", "con_id", F.coalesce("zip", F.lit(""))) == [(7, 1, ""), (7, 1, "z1"), (7, 1, "z2")]
    assert rows(t["phone"], "doc_id", "zip", "n") == [(0, "z1", "5"), (0, "z1", "6")]
    assert rows(t["card"], "app_id", "no") == [(7, "9")]
    assert mapped.findings.count() == 0


def test_documents_are_parsed_once(spark):
    mapped = fanout.fan_out(docs(spark, DOC), contract())
    for df in [*mapped.tables.values(), mapped.findings]:
        assert "xml_to_struct" not in (plan := df._jdf.queryExecution().optimizedPlan().toString()) and "from_xml" not in plan


def test_order_of_tables():
    assert fanout.insertion_order(contract(order=["phone", "address", "card"])) == ["base", "card", "party", "address", "phone"]
    with pytest.raises(ValueError, match="circle"):
        fanout.insertion_order(contract(relationships=[Relationship("party", "address", "x", PARTY, ADDRESS), Relationship("address", "party", "y", ADDRESS, PARTY)]))


def test_contracts_are_read_from_json():
    raw = {
        "xml_root_element": "R", "xml_application_path": APP, "mappings": [],
        "relationships": [{"parent_table": "a", "child_table": "b", "foreign_key_column": "k", "xml_parent_path": APP, "xml_child_path": PARTY, "note": "ignored"}],
    }
    assert Contract.load(json.dumps(raw)).relationships == [Relationship("a", "b", "k", APP, PARTY)]


def test_what_a_contract_may_not_say(spark):
    def elements(name, *relationships):
        c = contract(relationships=relationships)
        fanout.FanOut(fanout.parse(docs(spark, DOC), c), c).elements(name)

    with pytest.raises(ValueError, match="has no column"):
        elements("party", Relationship("base", "party", "nothing", APP, PARTY))
    with pytest.raises(ValueError, match="several child paths"):
        elements("party", Relationship("base", "party", "app_id", APP, PARTY), Relationship("base", "party", "app_id", APP, ADDRESS))
    with pytest.raises(ValueError, match="repeats, so a relationship"):
        elements("address")


def test_enums_by_name(spark):
    """Codes are found by a part of the column's name; a nullable column stays null and is reported, a required one gets its default or fails."""
    c = contract(
        Mapping(APP, "s", "base", "process_status", "smallint", None, ["enum"], default_value=7), Mapping(APP, "s", "base", "app_status", "smallint", None, ["enum"], default_value=8, nullable=False),
        Mapping(APP, "s", "base", "nothing_enum", "smallint", None, ["enum"]), Mapping(APP, "t", "base", "status_enum", "smallint", None, ["enum"], nullable=False),
    )
    mapped = fanout.fan_out(docs(spark, "<R><app id='1' s='a' t='A'/></R>", "<R><app id='2' s='Z' t='Z'/></R>", "<R><app id='3' t='A'/></R>"), c)
    got = {r.doc_id: (r.process_status, r.app_status, r.nothing_enum, r.status_enum) for r in mapped.tables["base"].collect()}
    assert got == {0: (1, 1, None, 1), 1: (None, 8, None, None), 2: (None, 8, None, 1)}
    found = {(r.doc_id, r.field, r.severity) for r in mapped.findings.collect()}
    assert found == {(0, "nothing_enum", "warning"), (1, "nothing_enum", "warning"), (1, "process_status", "warning"), (1, "status_enum", "critical")}


def test_keep_filters_mapped_rows(spark):
    mapped = fanout.fan_out(docs(spark, DOC), contract(), keep={"address": lambda df: df.filter("zip <> ''")})
    assert rows(mapped.tables["address"], "zip") == [("z1",), ("z2",)]


def test_load_logs_and_resumes(spark, tmp_path):
    """What is broken or lacks a required value is logged and seen nowhere; a second run takes only what is new."""
    path, c = str(tmp_path / "out"), contract()
    fanout.load(docs(spark, DOC, "<R><app", "<R><app/></R>"), c, path, "s1")
    fanout.load(docs(spark, DOC, "<R><app id='5'/></R>", "<R><app/></R>", "<R><app id='6'/></R>"), c, path, "s2")
    log = {r.app_id: (r.status, r.failure_reason, r.session_id) for r in fanout.outcomes(spark, path).collect()}
    assert log == {0: ("success", None, "s1"), 1: ("failed", "parsing: not well formed", "s1"), 2: ("failed", "mapping: base.app_id: no value and no default", "s1"), 3: ("success", None, "s2")}
    assert rows(sinks.visible(spark, path, "base"), "doc_id", "app_id") == [(0, 7), (3, 6)]
    fanout.load(docs(spark, DOC, "<R><app id='5'/></R>", "<R><app id='9'/></R>"), c, path, "s3", retry_failed=True)
    assert rows(sinks.visible(spark, path, "base"), "doc_id", "app_id") == [(0, 7), (1, 5), (2, 9), (3, 6)]


def test_a_batch_that_dies_is_seen_once(spark, tmp_path, monkeypatch):
    """The log isn't written the first time: rows are there but unseen. Run again, each document is there and logged once."""
    source, out, checkpoint, c = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "log"), contract()
    data = docs(spark, *[DOC.replace("id='7'", f"id='{i}'") for i in range(6)])
    data.unionByName(data.filter("doc_id < 2")).coalesce(1).write.parquet(source)
    commit = sinks.commit_documents

    def dies(frames, failed, log, order, path, id, run):
        sinks.write_tables({n: df.withColumn(sinks.RUN, F.lit(run)) for n, df in frames.items()}, order, path)
        raise RuntimeError("lost the driver")

    monkeypatch.setattr(sinks, "commit_documents", dies)
    with pytest.raises(Exception, match="lost the driver"):
        incremental.stream_load(spark, source, data.schema, c, out, checkpoint, "s")
    assert not sinks.exists(spark, f"{out}/processing_log")
    monkeypatch.setattr(sinks, "commit_documents", commit)
    incremental.stream_load(spark, source, data.schema, c, out, checkpoint, "s")
    assert spark.read.parquet(f"{out}/base").count() == 12  # of which the first run's are never seen
    assert rows(sinks.visible(spark, out, "base"), "doc_id", "app_id") == [(i, i) for i in range(6)]
    assert rows(sinks.visible(spark, out, "party"), "doc_id", "con_id") == [(i, k) for i in range(6) for k in (1, 2)]
    assert rows(fanout.outcomes(spark, out), "app_id", "status") == [(i, "success") for i in range(6)]
    # a batch whose log was written, but not its checkpoint, finds nothing to do
    incremental.stream_load(spark, source, data.schema, c, out, str(tmp_path / "other"), "s")
    assert fanout.outcomes(spark, out).count() == 6 and spark.read.parquet(f"{out}/base").count() == 12


def test_late_duplicates_and_a_state_that_shrinks(spark, tmp_path):
    """Inside the bound a repeated id goes; later it is new; a row behind the watermark goes. Ids are forgotten."""
    source, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "log")
    schema = "doc_id long, at timestamp"

    def send(*sent):
        spark.createDataFrame([(i, f"2024-01-{day:02d} 00:00:00") for i, day in sent], "doc_id long, at string").selectExpr("doc_id", "cast(at as timestamp) as at").coalesce(1).write.mode("append").parquet(source)
        incremental.stream_dedupe(spark, source, spark.createDataFrame([], schema).schema, out, checkpoint, event_time="at", late="2 days")
        return sorted((r.doc_id, r["at"].day) for r in spark.read.parquet(out).select("doc_id", "at").collect())

    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        send(*[(i, 1) for i in range(50)])
        assert send((1, 2), (100, 9)) == [*[(i, 1) for i in range(50)], (100, 9)]  # id 1 again, a day later: once
        got = send((2, 3), (3, 9), (100, 8))
        assert (2, 3) not in got  # behind the watermark (the 7th): dropped
        assert (3, 9) in got  # sent again after it was forgotten: new
        assert (100, 8) not in got  # out of order, but within the bound
        state = spark.read.format("statestore").load(checkpoint)
        assert {r.key.doc_id for r in state.select("key").collect()} == {100, 3}  # 50 ids were forgotten
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
