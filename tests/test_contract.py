"""Contracts by themselves: picks, rows, required and conditional values, unknown types."""

import pytest
from pyspark.sql import functions as F

from docmill.operators import shred, sinks, summarize
from docmill.plans import contract as k
from docmill.plans.dispatch import record_rows

PARTY, ADDRESS, CARD = "/R/app/contact", "/R/app/contact/address", "/R/app/contact/card"
AT = {"/R/app": "d.app", PARTY: "d.app.contact"}


def contract(*mappings):
    return k.Contract("R", "/R/app", [PARTY, ADDRESS, CARD], list(mappings), {PARTY: {"id": True, "role": ["PR", "AU"]}, ADDRESS: {"kind": ["CURR", "PREV"]}}, {"role": {"AU": 7}}, {"char_to_bit": {"Y": 1, "N": 0, "": 0}})


def rows(spark, c, *bodies):
    docs = spark.createDataFrame([(i, f"<R><app a='{i}'>{b}</app></R>") for i, b in enumerate(bodies)], "doc_id long, xml string")
    return k.parse(docs, c)


DOC = (
    "<contact id='1' role='PR' name='first' mail='m1'><address kind='CURR' zip='11111'/></contact>"
    "<contact id='2' role='PR' name='last' mail=' null '><address kind='PREV' zip='22222'/><address kind='CURR' zip=''/><address kind='CURR' zip='33333'/><address kind='CURR' zip='44444'/><card n='5'/><card n='6'/></contact>"
    "<contact id='' role='PR' name='no id'/><contact id='3' role='AU' name='au'><address kind='PREV' zip='55555'/></contact><contact id=' ' role='AU' name='blank' flag='Y'/>"
)


@pytest.mark.parametrize("kind,path,attribute,want", [
    ("last_valid_pr_contact", PARTY, "name", "last"), ("last_valid_sec_contact", PARTY, "name", "au"), ("authu_contact", PARTY, "name", "blank"),
    ("last_valid_pr_contact", ADDRESS, "zip", "33333"), ("last_valid_sec_contact", ADDRESS, "zip", "55555"), ("last_valid_pr_contact", CARD, "n", "6"),
])
def test_picks(spark, kind, path, attribute, want):
    c = contract(k.Mapping(path, attribute, "t", "v", mapping_type=[kind]))
    got = k.table(rows(spark, c, DOC, "", "<contact id='9' role='XX' name='other'/>"), c, "t", AT, ["doc_id"]).orderBy("doc_id").collect()
    assert [r.v for r in got] == [want, None, None]


def test_picks_go_on_in_the_chain(spark):
    c = contract(k.Mapping(PARTY, "role", "t", "role_enum", "smallint", None, ["authu_contact", "enum"], enum_name="role"), k.Mapping(PARTY, "flag", "t", "flag", "bit", None, "authu_contact, char_to_bit"), k.Mapping(PARTY, "id", "t", "pr", "int", None, ["last_valid_pr_contact"], default_value=-1))
    got = k.table(rows(spark, c, DOC, ""), c, "t", AT, ["doc_id"]).orderBy("doc_id").collect()
    assert [(r.role_enum, r.flag, r.pr) for r in got] == [(7, 1, 2), (None, 0, -1)]


def test_current_address(spark):
    """The last address of the preferred type of each party; another type is none."""
    c = contract(k.Mapping(ADDRESS, "zip", "t", "zip", mapping_type=["curr_address_only"]))
    parties = shred.explode_path(rows(spark, c, DOC), AT[PARTY], "contact")
    assert [r.zip for r in k.table(parties, c, "t", {PARTY: "contact"}, ["contact_pos"]).orderBy("contact_pos").collect()] == ["11111", "44444", None, None, None]


def test_key_value_rows(spark):
    c = contract(
        k.Mapping("/R/app", "a", "scores", "", "int", None, ["add_score(S)"]), k.Mapping(PARTY, "id", "scores", "", "int", None, ["last_valid_sec_contact", "add_score(T)"]),
        k.Mapping("/R/app", "a", "scores", "", "int", None, ["add_score()"]),  # without a name: no rows
        k.Mapping(PARTY, "mail", "history", "", "string", None, ["last_valid_pr_contact", "add_history"]), k.Mapping("/R/app", "a", "reports", "", "string", None, ["add_report_lookup(K)"]),
    )
    docs = rows(spark, c, DOC, "")
    assert sorted(map(tuple, record_rows(docs, c, "scores", AT).collect())) == [(0, "S", 0), (0, "T", 3), (1, "S", 1)]
    assert list(map(tuple, record_rows(docs, c, "history", AT).collect())) == [(0, "[mail]", "[contact]", "m1")]
    assert sorted(map(tuple, record_rows(docs, c, "reports", AT).collect())) == [(0, "a", "0", "K"), (1, "a", "1", "K")]


def test_grouped_rows(spark):
    c = contract(
        k.Mapping(PARTY, "name", "w", "company", "string", 20, ["last_valid_pr_contact", "warranty_field(601)"]), k.Mapping(PARTY, "flag", "w", "lien", "bit", None, ["authu_contact", "char_to_bit", "warranty_field(601)"]),
        k.Mapping(PARTY, "flag", "w", "lien", "bit", None, ["authu_contact", "char_to_bit", "warranty_field(602)"]),  # a flag alone makes no row
        k.Mapping("/R/app", "a", "s", "wholesale_value", "int", None, ["add_collateral(1)"]), k.Mapping("/R/app", "a", "s", "year", "int", None, ["numbers_only", "add_collateral(2)"]),
        k.Mapping("/R/app", "a", "p", "reason_code", "string", None, ["policy_exceptions(630)"]), k.Mapping(PARTY, "name", "p", "notes", "string", None, ["last_valid_pr_contact", "policy_exceptions()"]),
    )
    docs = rows(spark, c, DOC, "")
    assert list(map(tuple, record_rows(docs, c, "w", AT).collect())) == [(0, 601, "last", 1)]
    assert sorted(tuple(r) for r in record_rows(docs, c, "s", AT).select("doc_id", "sort_order", F.coalesce("wholesale_value", F.lit(-1)), F.coalesce("year", F.lit(-1))).collect()) == [(0, 2, -1, 0), (1, 1, 1, -1), (1, 2, -1, 1)]
    assert sorted(tuple(r) for r in record_rows(docs, c, "p", AT).select("doc_id", "policy_exception_type_enum", "reason_code", F.coalesce("notes", F.lit("-"))).collect()) == [(0, 630, "0", "last"), (1, 630, "1", "-")]
    with pytest.raises(ValueError, match="row-creating"):
        record_rows(docs, c, "t", AT)


def test_required_without_default_rejects(spark):
    """A document that lacks a required value is in no row, and in the findings; a default saves it."""
    c = contract(k.Mapping(PARTY, "mail", "t", "mail", nullable=False), k.Mapping(PARTY, "id", "t", "id", "int", default_value=0, nullable=False))
    parties = shred.explode_path(rows(spark, c, DOC, "<contact mail='x'/><contact mail='y' id='4'/>"), AT[PARTY], "contact")
    made, found = k.checked_table(parties, c, "t", {PARTY: "contact"}, ["doc_id", "contact_pos"])
    assert [(r.doc_id, r.mail, r.id) for r in made.orderBy("contact_pos").collect()] == [(1, "x", 0), (1, "y", 4)]
    assert {(r.doc_id, r.field, r.severity) for r in found.collect()} == {(0, "mail", "critical")}


def test_conditional_defaults(spark):
    c = contract(k.Mapping(PARTY, "id", "t", "con_id", "int"), k.Mapping(PARTY, "name", "t", "name"), k.Mapping(PARTY, "mail", "t", "mail"), k.Mapping(PARTY, "born", "t", "born", default_value="1900-01-01", exclude_default_when_record_empty=True))
    parties = shred.explode_path(rows(spark, c, "<contact id='1' name='n' mail='m'/><contact id='2' name='n'/><contact id='3' born='2001-02-03'/>"), AT[PARTY], "contact")
    got = k.table(parties, c, "t", {PARTY: "contact"}, ["contact_pos"]).orderBy("contact_pos").collect()
    assert [r.born for r in got] == ["1900-01-01", None, "2001-02-03"]


def test_unknown_types_are_found():
    c = contract(k.Mapping("/R/app", "a", "t", "x", mapping_type=["numbers_only", "ad_score(A)"]), k.Mapping("/R/app", "a", "t", "y", mapping_type=["add_score(A)", "last_valid_pr_contact"]))
    assert c.unknown_types() == [("t", "x", "ad_score(A)")]


def test_rows_of_a_run_that_died_stay_unseen(spark, tmp_path):
    """One run dies before its log, another commits the same documents: each row is seen once. So it is after a second commit."""
    path, rows = str(tmp_path / "out"), spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "doc_id long, v string")
    none = spark.createDataFrame([], "doc_id long, stage string, message string")
    log = sinks.log_outcomes(rows.select("doc_id").distinct(), none, "s")
    sinks.write_tables({"t": rows.withColumn(sinks.RUN, F.lit("died"))}, ["t"], path)
    for _ in range(2):
        sinks.commit_documents({"t": rows}, none, log, ["t"], path)
        assert sorted(map(tuple, sinks.visible(spark, path, "t").collect())) == [(1, "a"), (1, "b"), (2, "c")]


def test_medians(spark):
    """Even and odd counts, one value, ties, null keys and values, a skewed range; bins of few and many values."""
    values = {"a": [1.0, 2.0, 3.0, 4.0], "b": [5.0], None: [7.0, 7.0, 7.0, 1.0, 9.0], "c": [0.0, 1e9, *[float(i) for i in range(1000)]], "d": [2.0, 2.0, 8.0, None, 8.0], "e": [None]}
    df = spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs], "k string, v double")
    want = {"a": 2.5, "b": 5.0, None: 7.0, "c": 499.5, "d": 5.0}
    for bins in (1, 3, 1024):
        assert {r.k: r["median"] for r in summarize.medians(df, ["k"], "v", bins).collect()} == want
    got = {r.k: (r.n, r["median"]) for r in summarize.stage_stats(df, ["k"], "v").collect()}
    assert got == {**{k: (sum(v is not None for v in values[k]), m) for k, m in want.items()}, "e": (0, None)}


def test_namespaces(spark):
    """Declarations and prefixes go, of elements and attributes; quoted and plain text keeps its colons."""
    xml = """<n:r xmlns:n="urn:x" xmlns='urn:y'><n:e n:v="a b:c=1" w='x:y="2"' n:z="k"/><t>time: 10:30 n:e</t></n:r>"""
    row = spark.createDataFrame([(xml,)], "x string").select(shred.strip_namespaces(F.col("x")).alias("x")).first()
    assert row.x == """<r><e v="a b:c=1" w='x:y="2"' z="k"/><t>time: 10:30 n:e</t></r>"""


def test_files_of_several_documents(spark, tmp_path):
    from docmill.sources import documents as d

    (tmp_path / "a.xml").write_text("<E><Request ID='x' ID=\"5\"/>\n</E>\n<E>\n<Request ID=\"6\"/></E> \n")
    (tmp_path / "b.xml").write_text('<E><Request ID="7"/></E>')
    rows = d.read_xml_dir(spark, str(tmp_path / "*.xml"), root="E").orderBy("doc_id").collect()
    assert [r.doc_id for r in rows] == [5, 6, 7] and all(r.xml.startswith("<E>") and r.xml.strip().endswith("</E>") for r in rows)
