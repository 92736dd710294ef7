"""Changes that touch only what they must, and audits whose work is dealt evenly."""

import re

import pytest
from pyspark.sql import functions as F

from docmill.operators import bucketed, paging, pick, reconcile, relate, sinks, summarize
from docmill.plans import dispatch
from docmill.plans.contract import Contract, Mapping


def files(table):
    return {f.rsplit("/", 1)[1]: re.search(r"_bucket=(-?\d+)", f)[1] for f in table.spark.read.parquet(table.path).inputFiles()}


def found(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


@pytest.fixture
def kv(spark, tmp_path):
    rows = [(i, f"k{i % 3}", i) for i in range(300)] + [(None, "k0", -1), (7, None, -2)]
    return bucketed.Bucketed(spark, str(tmp_path / "kv"), ["id", "name"], 32).create(spark.createDataFrame(rows, "id int, name string, value int"))


def test_upsert_rewrites_what_it_touches(spark, kv):
    before = files(kv)
    new = spark.createDataFrame([(5, "k2", 55), (5, "k2", 54), (5, "k2", None), (None, "k0", 9), (1000, "new", 1), (6, "k0", None)], "id int, name string, value int")
    touched = kv.upsert(new, ["value"])
    after = files(kv)
    assert 0 < len(touched) <= 4
    assert {f for f, b in before.items() if int(b) not in touched} == {f for f, b in after.items() if int(b) not in touched}
    assert not {f for f, b in before.items() if int(b) in touched} & set(after)
    got = {(r.id, r.name): r.value for r in kv.read().collect()}
    # repeated keys without an order: the largest value; null keys are keys; a null sets nothing
    assert got[(5, "k2")] == 55 and got[(None, "k0")] == 9 and got[(1000, "new")] == 1 and got[(6, "k0")] == 6 and len(got) == kv.read().count() == 303


def test_upsert_in_order(spark, kv):
    kv.upsert(spark.createDataFrame([(5, "k2", 55, 1), (5, "k2", 54, 2), (9, "k0", 1, 1), (9, "k0", None, 2)], "id int, name string, value int, pos int"), ["value"], "pos")
    assert found(kv.read().filter("id in (5, 9)"), "id", "value") == [(5, 54), (9, 9)]
    with pytest.raises(ValueError, match="neither keys nor values"):
        kv.upsert(spark.createDataFrame([(1, "k1")], "id int, name string"), [])


def test_insert_keeps_the_first_writer(spark, kv):
    before = files(kv)
    batch = spark.createDataFrame([(1, "k1", 99, 0), (400, "a", 2, 1), (400, "a", 1, 0), (401, "b", 5, 0), (7, None, 5, 0)], "id int, name string, value int, pos int")
    kv.insert_absent(batch.drop("pos"), "value")
    assert set(before) < set(files(kv))  # no file is rewritten
    assert found(kv.read().filter("id in (1, 400, 401) or name is null"), "id", "value") == [(1, 1), (400, 1), (401, 5), (7, -2)]
    kv.insert_absent(spark.createDataFrame([(401, "b", 6)], "id int, name string, value int"))
    assert found(kv.read().filter("id = 401"), "value") == [(5,)]


def test_backfill_appends_and_repeats_safely(spark, kv):
    expected = spark.createDataFrame([(i, f"k{i % 3}", i) for i in range(310)] + [(305, "k2", 305), (None, "k0", 4)], "id int, name string, value int")
    before = files(kv)
    assert tuple(kv.backfill(expected, apply=False).first()) == (10, 300, 309) and files(kv) == before
    assert kv.backfill(expected, apply=True).first().inserted == 10 and set(before) < set(files(kv))
    assert kv.backfill(expected, apply=True).first().inserted == 0
    assert kv.read().count() == 312 and found(kv.read().filter("id is null"), "value") == [(-1,)]


def test_delete_rewrites_what_holds_the_keys(spark, kv):
    before = files(kv)
    hit = kv.delete(spark.createDataFrame([(5, "k2"), (5, "none"), (None, "k0"), (9999, "x")], "id int, name string"))
    after = files(kv)
    assert len(hit) == 2 and {f for f, b in before.items() if int(b) not in hit} == {f for f, b in after.items() if int(b) not in hit}
    assert kv.read().count() == 300 and kv.delete(spark.createDataFrame([(9999, "x")], "id int, name string")) == []
    # a bucket of which nothing is left
    everything = kv.read().select("id", "name")
    kv.delete(everything)
    assert kv.read().count() == 0 and kv.read().columns == ["id", "name", "value"]
    kv.upsert(spark.createDataFrame([(1, "k1", 3)], "id int, name string, value int"), ["value"])
    assert found(kv.read(), "id", "name", "value") == [(1, "k1", 3)]


def test_delete_through_parents(spark, tmp_path):
    parent = bucketed.Bucketed(spark, str(tmp_path / "p"), ["app"], 8).create(spark.createDataFrame([(i, 10 * i) for i in range(20)], "app int, con int"))
    child = bucketed.Bucketed(spark, str(tmp_path / "c"), ["con"], 8).create(spark.createDataFrame([(10 * i, k) for i in range(20) for k in "ab"], "con int, v string"))
    bucketed.delete_ids({"p": parent, "c": child}, spark.createDataFrame([(3,), (4,), (99,)], "app int"), "app", {"c": ("p", "con")})
    assert {r.app for r in parent.read().collect()} == set(range(20)) - {3, 4} and {r.con for r in child.read().collect()} == {10 * i for i in range(20)} - {30, 40}


def test_empty_changes(spark, tmp_path):
    none = spark.createDataFrame([], "id int, name string, value int")
    table = bucketed.Bucketed(spark, str(tmp_path / "e"), ["id", "name"], 4).create(none)
    assert table.upsert(none, ["value"]) == [] == table.insert_absent(none) == table.delete(none)
    assert table.read().count() == 0 and table.backfill(none, apply=False).first().would_insert == 0
    with pytest.raises(ValueError, match="exists"):
        table.create(none)


def test_state_functions_settle_repeated_keys(spark):
    stored = spark.createDataFrame([(1, "a"), (None, "n")], "id int, v string")
    new = spark.createDataFrame([(1, "z"), (2, "y"), (2, "x"), (None, "m")], "id int, v string")
    assert found(sinks.insert_absent(new, stored, ["id"]), "id", "v") == [(1, "a"), (2, "x"), (None, "n")]
    assert found(sinks.upsert(new, stored, ["id"], ["v"]), "id", "v") == [(1, "z"), (2, "y"), (None, "m")]
    assert found(sinks.backfill(new, stored, ["id"], True), "id", "v") == [(1, "a"), (2, "x"), (None, "n")]
    assert found(pick.settle(new, ["id"], "v"), "id", "v") == [(1, "z"), (2, "x"), (None, "m")]
    assert pick.settle(new.select("id"), ["id"]).count() == 3


def test_null_keys_reconcile(spark):
    """A null key is a key, as for upsert()."""
    a = spark.createDataFrame([(None, "k", 1), (1, None, 2), (2, "k", 3)], "id int, name string, value int")
    got = reconcile.reconcile(a, a.filter("id is null or id = 1"), ["id", "name"], "value")
    assert found(got, "id", "outcome") == [(1, "PASS"), (2, "FAIL missing"), (None, "PASS")]


def test_outcomes_of_three_sides(spark):
    schema, kv_schema = "id int, name string, attribute string, raw string, expected string", "id int, name string, value string"
    source = spark.createDataFrame([
        (1, "a", "x", "1", "1"), (2, "a", "x", "1", "1"), (3, "a", "x", "1", "1"), (4, "a", "x", "1", "1"), (5, "a", "x", "1", "1"), (6, "a", "x", "odd", None), (7, "a", "x", " ", None),
        (8, "a", "big_SCORE", "0", "0"), (9, "a", "big_SCORE", "0.00", "0.00"), (10, "a", "x", "0", "0"), (11, "a", "x", "1", "1"), (14, "a", "x", None, None),
    ], schema)
    mapped = spark.createDataFrame([(i, "a", "1") for i in (1, 3, 4)] + [(8, "a", "0"), (9, "a", "0.00"), (10, "a", "0"), (11, "a", "2"), (12, "b", "5"), (13, "b", "5")], kv_schema)
    stored = spark.createDataFrame([(1, "a", "1"), (2, "a", "1"), (3, "a", "2"), (8, "a", "0"), (9, "a", "0.00"), (10, "a", "0"), (11, "a", "1"), (13, "b", "5"), (14, "a", "9")], kv_schema)
    got = {r.id: (r.outcome, r.cause, r.smell) for r in reconcile.reconcile_source(source, mapped, stored, ["id", "name"]).collect()}
    assert got == {
        1: ("PASS", None, None), 2: ("PASS", "not mapped", None), 3: ("FAIL", "differs", None), 4: ("FAIL", "not stored", None), 5: ("FAIL", "not mapped", None), 6: ("WARN", "value gives no row", None),
        7: ("PASS", "nothing to store", None), 8: ("PASS", None, "zero score"), 9: ("PASS", None, "zero score"), 10: ("PASS", None, None), 11: ("PASS", "not mapped", "mapped value differs"),
        12: ("WARN", "mapped without source", None), 13: ("WARN", "extra", None), 14: ("WARN", "extra", None),
    }


def test_three_sides_are_one_shuffle(spark):
    df = spark.createDataFrame([(1, "a", "x", "1", "1")], "id int, name string, attribute string, raw string, expected string")
    other = spark.createDataFrame([(1, "a", "1")], "id int, name string, value string")
    plan = reconcile.reconcile_source(df, other, other, ["id", "name"])._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bExchange\b", plan)) == 1 and "Join" not in plan


def test_issues_of_key_value_mappings():
    c = Contract("R", "/R/a", [], [Mapping("/R/a", "x", "scores", "", "int", None, ["add_history"]), Mapping("/R/a", "Old_Score", "history", "", "string", None, ["add_history"]), Mapping("/R/a", "y", "history", "", "string", None, ["add_history"])])
    assert dispatch.kv_issues(c, {"scores": "add_score", "history": "add_history"}) == [("scores", "x", "no add_score among its mapping types"), ("history", "Old_Score", "a score that is kept as history")]


@pytest.mark.parametrize("outlier", [1e9, 1e300])
def test_medians_of_skewed_values(spark, outlier):
    """One outlier, or a third of all rows with one value, leaves few values to order."""
    spread = spark.range(200_000).select(F.lit("a").alias("k"), (F.col("id") * 7919 % 200_003).cast("double").alias("v")).unionByName(spark.createDataFrame([("a", outlier)], "k string, v double"))
    hot = spark.range(90_000).select(F.lit("b").alias("k"), F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id").cast("double")).alias("v"))
    tiny = spark.createDataFrame([("c", 1.0), ("c", 2.0), ("d", 3.0), ("e", None)], "k string, v double")
    df = spread.unionByName(hot).unionByName(tiny)
    values = {}
    for r in df.collect():
        values.setdefault(r.k, []).append(r.v)
    want = {k: (sorted(v)[(len(v) - 1) // 2] + sorted(v)[len(v) // 2]) / 2 for k, v in values.items() if k != "e"}
    assert {r.k: r["median"] for r in summarize.medians(df, ["k"], "v").collect()} == want
    left = summarize.middle_values(df, ["k"], "v", summarize.brackets(df, ["k"], "v")).groupBy("_k").count().collect()
    assert max(r["count"] for r in left) < 300  # of 200,001 in the largest group


def test_collisions_of_a_hot_key(spark):
    """All documents of a key that a third of the rows have, in order, without a list; null keys are none."""
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.col("id") % 5000 + 10).alias("key"), (F.col("id") * 7919 % 30_011).alias("doc"))
    got = summarize.collision_documents(rows.unionByName(rows.limit(50)), "key", "doc")
    docs = {}
    for r in rows.filter("key is not null").collect():
        docs.setdefault(r.key, set()).add(r.doc)
    want = sorted((k, len(d), x, i) for k, d in docs.items() if len(d) > 1 for i, x in enumerate(sorted(d), 1))
    assert sorted(map(tuple, got.collect())) == want
    assert not [f for f in got.schema if f.dataType.typeName() == "array"]


def test_lookups_are_one_broadcast(spark):
    codes = spark.createDataFrame([(i, f"v{i}") for i in range(30)] + [(3, "zz"), (None, "n")], "enum_id int, value string")
    rows = spark.createDataFrame([(i, i + 1, i % 4, None) for i in range(40)], "a long, b int, c int, d int")
    few = relate.decode_enums(rows, codes, {c: f"{c}_name" for c in "abcd"})
    assert len(re.findall(r"BroadcastExchange", few._jdf.queryExecution().executedPlan().toString())) == 1
    many = relate.decode_enums(rows, codes, {c: f"{c}_name" for c in "abcd"}, most=5)
    names = [f"{c}_name" for c in "abcd"]
    assert found(few, "a", *names) == found(many, "a", *names)
    assert found(few.filter("a = 29"), *names) == [("v29", None, "v1", None)]


def test_suspects_are_one_shuffle_by_document(spark):
    one = spark.createDataFrame([(1, "XX", "0"), (2, "OH", "00000"), (3, "OH", "1"), (1, "XX", "00000")], "id int, state string, zip string")
    two = spark.createDataFrame([(2, 229), (4, 229), (5, 1)], "id int, code int")
    got = reconcile.suspects_over({"one": (one, {"state": ["XX"], "zip": ["00000"]}), "two": (two, {"code": [229, 423]})}, "id", spark.createDataFrame([(1,), (2,), (2,), (3,)], "id int"))
    assert found(got, "id", "n", "reasons") == [(1, 3, "one.state,one.zip"), (2, 2, "one.zip,two.code")]


def test_samples_of_any_id(spark):
    """No overflow at the ends of 64 bits; the same rows each time, others with another seed."""
    rows = spark.range(1000).select((F.col("id") + 2**62).alias("id")).unionByName(spark.createDataFrame([(2**63 - 1,), (-(2**63),), (3 * 10**14,), (None,)], "id long"))
    take = lambda seed: [r.id for r in paging.sample_seeded(rows, "id", 20, seed).collect()]
    assert take(1) == take(1) != take(2)
    assert len(paging.sample_n(rows, "id", 2000, 48271).collect()) == 1004
    assert len(paging.sample_n(rows, "id", 20, 2**40).collect()) == 20


def test_slots_with_amounts_that_are_no_numbers(spark):
    from docmill.operators import rows as r

    df = spark.createDataFrame([(1, "abc"), (2, "0"), (3, "5"), (4, None), (5, "1e400")], "id int, amount string")
    got = r.slot_rows(df, "id", [{"amount": F.col("amount"), "name": F.lit(None).cast("string")}], ["name"], "amount")
    assert sorted(x.id for x in got.collect()) == [3, 5]
