"""Documents made from orders, customers and lines; shredded back, and held against the tables that they came from."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import shred as s
from ..operators.filters import rule_filter, valid_party
from ..plans.contract import Contract, Mapping, parse, table
from ..sources import documents as d
from ..sources.staging import dealt, grouped_by_sort, shared_path, spread, staged
from .base import LINES, ORDER, RAW, Tables, query

ROOT, APP, CONTACT = "Envelope", "/Envelope/Request/CustData/application", "/Envelope/Request/CustData/application/contact"
_made: dict[tuple[str, str], DataFrame] = {}


def documents(t: Tables) -> DataFrame:
    """(doc_id, xml): a document for each order, staged once for each application and folder."""
    at = (t.spark.sparkContext.applicationId, t.folder)
    if at not in _made:
        with grouped_by_sort(t.spark):
            _made[at] = staged(build(t), "documents")
    return _made[at]


def tag(depth: int, name: str, attributes: dict[str, Column], inside: Column | None = None) -> Column:
    """An element as to_xml() writes it, on lines of its own: null attributes are left out, an element of nothing closes itself."""
    pad = "\n" + "    " * depth
    head = F.concat_ws("", F.lit(f"{pad}<{name}"), *[F.concat(F.lit(f' {n}="'), v, F.lit('"')) for n, v in attributes.items()])
    return F.concat(head, F.lit("/>") if inside is None else F.coalesce(F.concat(F.lit(">"), inside, F.lit(f"{pad}</{name}>")), F.lit("/>")))


def escaped(c: Column) -> Column:
    for a, b in {"&": "&amp;", "<": "&lt;", '"': "&quot;", "\n": "&#xa;", "\r": "&#xd;", "\t": "&#x9;"}.items():
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def build(t: Tables) -> DataFrame:
    """Only columns of the tables are shuffled; text is made of them behind the last join."""
    money = lambda c: c.cast("decimal(12,2)").cast("string")
    text = lambda c: c.cast("string")

    addresses = F.concat(
        tag(5, "contact_address", {"type": F.lit("PREV"), "supp": F.lit("0"), "months": F.lit("1")}),
        tag(5, "contact_address", {"type": F.when(F.col("l_linestatus") == "O", "CURR").otherwise("PREV"), "supp": text(F.col("l_suppkey")), "months": text(F.col("l_linenumber").cast("int"))}),
    )
    id = text(F.col("l_partkey"))
    contact = tag(4, "contact", {
        "con_id": id, "ac_role": escaped(F.col("l_returnflag")), "first_name": F.concat(F.lit("P&amp;"), id), "amount": money(F.col("l_extendedprice")),
        "qty": text(F.col("l_quantity").cast("int")), "n": text(F.col("l_linenumber").cast("int")),
    }, addresses)
    columns = LINES.split(", ")
    # dealt in any case: where the aggregation deals them itself, each map task first sorts its whole share of the file. Narrow rows are
    # sorted, and then become text, row by row: inside of a list, expressions are interpreted
    dealt_lines = spread(t.lineitem.select("l_orderkey", *columns).repartition("l_orderkey"), "l_orderkey").sortWithinPartitions("l_orderkey")
    lines = dealt_lines.select("l_orderkey", F.struct(*columns, contact.alias("text")).alias("line")).groupBy("l_orderkey").agg(F.sort_array(F.collect_list("line")).alias("lines"))
    orders = spread(t.orders, "o_custkey").join(dealt(t.customer.select("c_custkey", "c_mktsegment", "c_nationkey")), F.col("o_custkey") == F.col("c_custkey"), "left")
    both = orders.join(lines.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    kept = "c_mktsegment, c_nationkey, lines"
    rows = t.spark.sql(f"SELECT {RAW}, {kept} FROM (SELECT {ORDER}, {kept} FROM {{both}}) b", both=both)
    score_b = F.when(F.col("id") % 3 != 1, F.col("id") % 850)
    application = tag(3, "application", {
        "app_type_code": escaped(F.substring("pr", 1, 1)), "receive_date": F.col("dt"), "amount": F.col("p"), "signature_ind": escaped(F.col("flag")), "segment": escaped(F.col("c_mktsegment")),
        "nation": text(F.col("c_nationkey")), "score_a": escaped(F.col("num")), "score_b": text(score_b),
    }, F.array_join("lines.text", ""))
    request = tag(1, "Request", {"ID": text(F.col("id")), "Status": escaped(F.col("st")), "Priority": escaped(F.col("pr"))}, tag(2, "CustData", {}, application))
    return rows.select(F.col("id").alias("doc_id"), F.concat(F.lit(f"<{ROOT}>"), request, F.lit(f"\n</{ROOT}>")).alias("xml"))


CONTRACT = Contract(
    ROOT, APP, [CONTACT, f"{CONTACT}/contact_address"],
    [
        Mapping("/Envelope/Request", "ID", "app_base", "app_id", "bigint", nullable=False),
        Mapping("/Envelope/Request", "Status", "app_base", "status_enum", "smallint", mapping_type=["enum"], enum_name="status_enum"),
        Mapping("/Envelope/Request", "Priority", "app_base", "priority", "string", 6),
        Mapping(APP, "amount", "app_base", "amount", "decimal", 2),
        Mapping(APP, "signature_ind", "app_base", "signature_flag", "bit", mapping_type=["char_to_bit"]),
        Mapping(APP, "segment", "app_base", "segment", "string", 20),
        Mapping(CONTACT, "con_id", "contact", "con_id", "bigint"),
        Mapping(CONTACT, "ac_role", "contact", "role_enum", "smallint", mapping_type=["enum"], enum_name="role_enum"),
        Mapping(CONTACT, "first_name", "contact", "first_name", "string", 50),
        Mapping(CONTACT, "amount", "contact", "amount", "decimal", 2),
        Mapping(f"{CONTACT}/contact_address", "type", "address", "type", "string", 4),
        Mapping(f"{CONTACT}/contact_address", "supp", "address", "supp", "bigint"),
        Mapping(f"{CONTACT}/contact_address", "months", "address", "months", "smallint"),
    ],
    {CONTACT: {"con_id": True, "ac_role": ["A", "N", "R"]}},
    {"status_enum": {"F": 1, "O": 2, "P": 3, "": 9}, "role_enum": {"A": 10, "N": 11, "R": 12}},
    {"char_to_bit": {"Y": 1, "N": 0, "": 0, " ": 0}}, ["app_base", "contact", "address"],
)
TEXT = None
_contact = {"_con_id": TEXT, "_ac_role": TEXT, "_first_name": TEXT, "_amount": TEXT, "_n": TEXT, "contact_address": [{"_type": TEXT, "_supp": TEXT}]}
_application = {"_amount": TEXT, "_signature_ind": TEXT, "_receive_date": TEXT, "_score_a": TEXT, "_score_b": TEXT, "contact": [_contact]}
WIDE = s.schema_of({"Request": {"_ID": TEXT, "_Status": TEXT, "CustData": {"application": _application}}})


CONTACTS = "Request.CustData.application.contact"


def shredded(t: Tables, *paths: str) -> DataFrame:
    """Documents as structs that have the named paths of WIDE, as the parser's time goes to what it builds."""
    return s.shred(documents(t), s.pruned(WIDE, *paths))


def contacts(t: Tables, *names: str) -> DataFrame:
    """doc_id, contact_pos and the named attributes (con_id, role) or elements of each contact of the shredded documents."""
    inner = {"con_id": "_con_id", "role": "_ac_role"}
    rows = s.explode_path(shredded(t, *[f"{CONTACTS}.{inner.get(n, n)}" for n in names]), f"d.{CONTACTS}", "contact")
    return rows.select("doc_id", "contact_pos", *[(F.trim if n in inner else lambda c: c)(F.col(f"contact.{inner.get(n, n)}")).alias(n) for n in names])


BASE_SQL = (
    "SELECT id AS app_id, CASE st WHEN 'F' THEN 1 WHEN 'O' THEN 2 WHEN 'P' THEN 3 END AS status_enum, trim(substr(pr, 1, "
    "6)) AS priority, CAST(CAST(p AS DECIMAL(12,2)) AS DOUBLE) AS amount, CASE WHEN upper(trim(flag)) = 'Y' THEN 1 ELSE 0 "
    "END AS signature_flag, c_mktsegment AS segment FROM raw LEFT JOIN customer ON cust = c_custkey"
)


@query("xml_shred", BASE_SQL)
def xml_shred(t):
    """The flagship: documents to the base table by contract; from_xml builds only the contract's paths."""
    rows = parse(documents(t), CONTRACT)
    out = table(rows, CONTRACT, "app_base", {"/Envelope/Request": "d.Request", APP: "d.Request.CustData.application"}, [])
    return out.withColumn("amount", F.col("amount").cast("double"))


def dirty(t: Tables) -> DataFrame:
    """Documents of which some are damaged, by rule."""
    k = F.col("doc_id") % 50
    x = F.col("xml")
    return documents(t).select(
        "doc_id",
        F.when(k == 0, F.concat(F.substring(x, 1, 60), F.lit("~"))).when(k == 1, "").when(k == 2, F.concat(F.lit("x"), x)).when(k == 3, F.replace(x, F.lit(ROOT), F.lit("Other"))).when(k == 4, F.replace(x, F.lit("</Request>"), F.lit("<Request>"))).when(k == 5, F.concat(F.lit("﻿\r\n"), x)).otherwise(x).alias("xml"),
    )


@query("scan_documents", "SELECT o_orderkey AS doc_id, o_orderkey % 50 = 5 AS marked FROM orders WHERE o_orderkey % 50 <> 1")
def scan_documents(t):
    path = shared_path(t.spark, "dirty")
    dirty(t).write.option("compression", "zstd").parquet(path)
    return d.read_documents(t.spark, path, "doc_id", "xml").select("doc_id", F.col("xml").startswith("﻿").alias("marked"))


@query("scan_table", "SELECT o_orderkey AS doc_id FROM orders WHERE o_orderkey % 50 <> 1 AND o_orderkey >= 100 AND o_orderkey <= (SELECT max(o_orderkey) - 100 FROM orders)")
def scan_table(t):
    """Documents of a catalog table, from one id to another; blank ones are left out."""
    name, path = f"docs_{uuid.uuid4().hex}", shared_path(t.spark, "dirty-table")
    dirty(t).write.option("path", path).saveAsTable(name)
    last = t.orders.agg(F.max("o_orderkey")).first()[0]
    found = d.slice_range(d.read_table(t.spark, name, "doc_id", "xml"), 100, last - 100).select("doc_id")
    out = staged(found, "scanned")
    t.spark.sql(f"DROP TABLE {name}")
    return out


@query("scan_xml_files", "SELECT o_orderkey AS doc_id, o_orderkey % 2 = 0 AS even, o_orderstatus AS status FROM orders")
def scan_xml_files(t):
    """Documents written as files of some thousand documents each, with line breaks inside of them, read back and shredded."""
    path = shared_path(t.spark, "xml-files")
    documents(t).select(F.col("xml").alias("value")).write.options(maxRecordsPerFile=2000, compression="gzip").text(path)
    rows = s.shred(d.read_xml_dir(t.spark, f"{path}/part-*", root=ROOT).select("doc_id", "xml"), s.schema_of({"Request": {"_Status": TEXT}}))
    return rows.select("doc_id", (F.col("doc_id") % 2 == 0).alias("even"), F.col("d.Request._Status").alias("status"))


@query("xml_clean", "SELECT o_orderkey AS doc_id, o_orderkey % 50 NOT IN (1, 2) AS opens FROM orders")
def xml_clean(t):
    x = s.clean_xml(F.col("xml"))
    return dirty(t).select("doc_id", x.startswith("<").alias("opens"))


@query(
    "xml_valid",
    "SELECT o_orderkey AS doc_id, CASE o_orderkey % 50 WHEN 0 THEN 'ends' WHEN 1 THEN 'empty' WHEN 2 THEN 'starts' WHEN 3 "
    "THEN 'root' WHEN 4 THEN 'well_formed' ELSE 'ok' END AS status FROM orders",
)
def xml_valid(t):
    docs = dirty(t).withColumn("xml", s.clean_xml(F.col("xml")))
    return s.xml_status(docs, ROOT, WIDE)


@query("path_last_wins", "SELECT o_orderkey AS doc_id, concat('b', CAST(o_custkey AS STRING)) AS v FROM orders")
def path_last_wins(t):
    """Of an element that should be single, the last one."""
    xml = F.concat(F.lit('<r><e v="a'), "o_orderkey", F.lit('"/><e v="b'), "o_custkey", F.lit('"/></r>'))
    return s.shred(
        t.orders.select(F.col("o_orderkey").alias("doc_id"), xml.alias("xml")), s.schema_of({"e": {"_v": TEXT}}),
    ).select("doc_id", F.col("d.e._v").alias("v"))


@query("attr_value", "SELECT o_orderkey AS doc_id, concat(o_orderpriority, ' & <', o_orderstatus, '>') AS v, CAST(NULL AS STRING) AS gone FROM orders")
def attr_value(t):
    """Names in any case, entities resolved once, trimmed; a missing attribute is null."""
    xml = F.concat(F.lit('<r><e Val="  '), "o_orderpriority", F.lit(" &amp; &lt;"), "o_orderstatus", F.lit('&gt; "/></r>'))
    rows = s.shred(t.orders.select(F.col("o_orderkey").alias("doc_id"), xml.alias("xml")), s.schema_of({"e": {"_val": TEXT, "_gone": TEXT}}))
    return rows.select("doc_id", s.attr("d.e", "val").alias("v"), s.attr("d.e", "gone").alias("gone"))


@query("ns_strip", "SELECT o_orderkey AS doc_id, CAST(o_custkey AS STRING) AS v FROM orders")
def ns_strip(t):
    xml = F.concat(F.lit('<n:r xmlns:n="urn:x"><n:e v="'), "o_custkey", F.lit('"/></n:r>'))
    docs = t.orders.select(F.col("o_orderkey").alias("doc_id"), xml.alias("xml"))
    rows = s.shred(docs, s.schema_of({"e": {"_v": TEXT}}), namespaces=False)
    return rows.select("doc_id", F.col("d.e._v").alias("v"))


@query("element_text", "SELECT o_orderkey AS doc_id, o_orderpriority AS v FROM orders")
def element_text(t):
    xml = F.concat(F.lit('<r><e k="1"> '), "o_orderpriority", F.lit(" </e></r>"))
    rows = s.shred(t.orders.select(F.col("o_orderkey").alias("doc_id"), xml.alias("xml")), s.schema_of({"e": {"_VALUE": TEXT, "_k": TEXT}}))
    return rows.select("doc_id", s.element_text("d.e").alias("v"))


@query("tail_text", "SELECT o_orderkey AS doc_id, CASE WHEN o_orderkey % 4 = 1 THEN NULL WHEN o_orderkey % 4 <> 3 THEN o_orderpriority END AS tail FROM orders")
def tail_text(t):
    """Text behind an element: before the next one, before the parent's end, none, or a malformed document."""
    k, p = F.col("o_orderkey") % 4, F.col("o_orderpriority")
    text = F.when(k == 0, F.concat(F.lit("<r><e>x</e> "), p, F.lit(" <e>y</e>z</r>"))).when(k == 1, F.concat(F.lit("<r>"), p, F.lit("<e>x</e></r>"))).when(k == 2, F.concat(F.lit("<r><e/>"), p, F.lit("</r>")))
    docs = t.orders.select(F.col("o_orderkey").alias("doc_id"), text.otherwise("<r><e></r>").alias("xml"))
    parsed = F.from_xml("xml", s.with_corrupt(s.schema_of({"e": [{"_VALUE": TEXT}]})), s.PERMISSIVE)["_corrupt_record"].isNull()
    return docs.select("doc_id", s.tail_text(F.col("xml"), "/r/e", parsed).alias("tail"))


@query(
    "explode_contacts",
    "SELECT app_id, pos, con_id, CASE role WHEN 'A' THEN 10 WHEN 'N' THEN 11 WHEN 'R' THEN 12 END AS role_enum, "
    "concat('P&', CAST(con_id AS STRING)) AS first_name, CAST(CAST(amount AS DECIMAL(12,2)) AS DOUBLE) AS amount FROM "
    "contacts",
)
def explode_contacts(t):
    """The contact table by contract, in document order."""
    rows = s.explode_path(parse(documents(t), CONTRACT), "d.Request.CustData.application.contact", "contact")
    out = table(rows, CONTRACT, "contact", {CONTACT: "contact"}, ["doc_id", "contact_pos"])
    return out.select(
        F.col("doc_id").alias("app_id"), F.col("contact_pos").alias("pos"), "con_id", "role_enum", "first_name",
        F.col("amount").cast("double").alias("amount"),
    )


@query(
    "explode_children",
    "SELECT app_id, con_id, pos, CASE WHEN line = 'O' THEN 'CURR' ELSE 'PREV' END AS type, supp, n AS months FROM contacts "
    "WHERE role IN ('A', 'R') UNION ALL SELECT app_id, con_id, pos, 'PREV', 0, 1 FROM contacts WHERE role IN ('A', 'R')",
)
def explode_children(t):
    """Addresses of contacts that the filter keeps, with the contact's key."""
    rows = s.explode_path(parse(documents(t), CONTRACT), "d.Request.CustData.application.contact", "contact")
    kept = rule_filter(rows.withColumns({"con_id": F.col("contact._con_id"), "role": F.col("contact._ac_role")}), {"con_id": True, "role": ["a", "r"]})
    children = s.explode_child(kept, "contact.contact_address", "address", "con_id", "contact_pos")
    out = table(children, CONTRACT, "address", {f"{CONTACT}/contact_address": "address"}, ["doc_id", "con_id", "contact_pos"])
    return out.select(
        F.col("doc_id").alias("app_id"), F.col("con_id").cast("bigint").alias("con_id"), F.col("contact_pos").alias("pos"), "type", "supp",
        F.col("months").cast("int").alias("months"),
    )


@query("nested_fk", "SELECT app_id, con_id, count(*) AS n FROM contacts WHERE con_id % 7 <> 0 GROUP BY app_id, con_id")
def nested_fk(t):
    """Children of contacts without an id are left out."""
    rows = contacts(t, "con_id", "contact_address").withColumn("con_id", F.when(F.col("con_id").cast("bigint") % 7 != 0, F.col("con_id")).otherwise(""))
    children = s.explode_child(rows, "contact_address", "address", "con_id").filter("address_pos = 1")
    return s.attach_fk(children, "con_id").groupBy(F.col("doc_id").alias("app_id"), F.col("con_id").cast("bigint").alias("con_id")).agg(F.count("*").alias("n"))


@query(
    "xml_path_value",
    "SELECT o_orderkey AS doc_id, CASE WHEN o_orderkey % 50 NOT IN (0, 4) THEN o_orderkey END AS id FROM orders WHERE "
    "o_orderkey % 50 NOT IN (1, 2, 3, 5)",
)
def xml_path_value(t):
    parsed = F.from_xml("xml", s.with_corrupt(WIDE), s.PERMISSIVE)["_corrupt_record"].isNull()
    docs = dirty(t).filter(F.col("xml").startswith(f"<{ROOT}"))
    return docs.select("doc_id", s.xml_value(F.col("xml"), f"/{ROOT}/Request/@ID", "bigint", parsed).alias("id"))


@query("xml_contains", "SELECT o_orderkey AS doc_id FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)")
def xml_contains(t):
    return documents(t).filter(s.has_tag(F.col("xml"), "contact ")).select("doc_id")


@query(
    "attr_eav",
    "SELECT id AS doc_id, 'score_a' AS name, trim(num) AS value FROM raw WHERE num IS NOT NULL UNION ALL SELECT id, "
    "'score_b', CAST(id % 850 AS STRING) FROM raw WHERE id % 3 <> 1",
)
def attr_eav(t):
    rows = shredded(t, "Request.CustData.application._score_a", "Request.CustData.application._score_b")
    names = [f.name for f in WIDE["Request"].dataType["CustData"].dataType["application"].dataType.fields if f.name.startswith("_score_")]
    return s.attr_rows(rows, "doc_id", {n[1:]: F.trim(F.col(f"d.Request.CustData.application.{n}")) for n in names})


@query("stage_reduce", "SELECT o_orderkey AS doc_id, o_orderstatus AS status, CAST(NULL AS STRING) AS gone FROM orders WHERE o_orderkey % 50 NOT IN (0, 1, 4)")
def stage_reduce(t):
    """Smaller documents, staged: an id, a status and the amount; the rest is no more there."""
    small = s.schema_of({"Request": {"_ID": TEXT, "_Status": TEXT, "CustData": {"application": {"_amount": TEXT}}}})
    kept = d.reduce_documents(
        dirty(t).filter(F.col("doc_id") % 50 != 2).unionByName(documents(t).filter("doc_id % 50 = 2")), small, ROOT,
        ["Request._ID", "Request.CustData"],
    )
    back = s.shred(kept, s.schema_of({"Request": {"_ID": TEXT, "_Status": TEXT, "_Priority": TEXT, "CustData": {"application": {"_amount": TEXT}}}}))
    return back.select("doc_id", F.col("d.Request._Status").alias("status"), F.col("d.Request._Priority").alias("gone"))


@query(
    "app_context",
    "SELECT o_orderkey AS doc_id, o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(12,2))::DOUBLE AS amount, (SELECT "
    "c.con_id FROM contacts c WHERE c.app_id = o_orderkey ORDER BY CASE WHEN role = 'A' THEN 0 ELSE 1 END, pos LIMIT 1) AS "
    "con_id FROM orders",
)
def app_context(t):
    """A row for each document: its own attributes, and the first contact of the primary role, else the first."""
    a = "d.Request.CustData.application"
    primary = F.coalesce(F.get(F.filter(f"{a}.contact", lambda x: x["_ac_role"] == "A"), 0), F.get(f"{a}.contact", 0))
    needed = ["Request._Status", "Request.CustData.application._amount", f"{CONTACTS}._con_id", f"{CONTACTS}._ac_role"]
    return shredded(t, *needed).select(
        "doc_id", F.col("d.Request._Status").alias("status"), F.col(f"{a}._amount").cast("decimal(12,2)").cast("double").alias("amount"),
        primary["_con_id"].cast("bigint").alias("con_id"),
    )


@query("range_slice", "SELECT o_orderkey AS doc_id FROM orders WHERE o_orderkey BETWEEN 100 AND 20000")
def range_slice(t):
    return d.slice_range(t.orders.select(F.col("o_orderkey").alias("doc_id")), 100, 20000)


@query("modulo_shard", "SELECT o_orderkey AS doc_id FROM orders WHERE o_orderkey % 4 = 1")
def modulo_shard(t):
    return d.shard(t.orders.select(F.col("o_orderkey").alias("doc_id")), 4, 1)


@query("keyset_page", "SELECT o_orderkey AS doc_id FROM orders WHERE o_orderkey > 500 ORDER BY o_orderkey LIMIT 500")
def keyset_page(t):
    return d.next_page(t.orders.select(F.col("o_orderkey").alias("doc_id")), 500, 500)


@query("genuine_semi_join", "SELECT o_orderkey AS doc_id FROM orders WHERE o_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def genuine_semi_join(t):
    ids = t.orders.select(F.col("o_orderkey").alias("doc_id"))
    return d.semi(ids, t.orders.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("doc_id")), "doc_id")


@query("resume_anti_join", "SELECT o_orderkey AS app_id FROM orders WHERE o_orderkey NOT IN (SELECT app_id FROM log)")
def resume_anti_join(t):
    return d.unprocessed(t.orders.select(F.col("o_orderkey").alias("app_id")), t.log, "app_id")


@query("first_by_id", "SELECT app_id, con_id FROM contacts WHERE pos = 0")
def first_by_id(t):
    return d.first_by_id(t.contacts, "app_id", "pos").select("app_id", "con_id")


@query(
    "metrics_nested",
    "SELECT batch, run AS stage, count(*) AS n, round(sum(seconds), 4) AS seconds FROM metrics WHERE batch <> 3 GROUP BY batch, run",
)
def metrics_nested(t):
    """Nested run files, one JSON object over many lines for each session's chunk; a pattern leaves a session out."""
    path = shared_path(t.spark, "run-files")
    item = F.struct(F.struct(F.col("item").alias("id"), F.col("run").alias("stage")).alias("work"), F.col("seconds"))
    runs = t.metrics.groupBy("batch", "chunk").agg(F.collect_list(item).alias("items"))
    text = F.to_json(F.struct(F.struct(F.concat(F.lit("session_"), "batch").alias("name"), "batch").alias("session"), F.struct("chunk", "items").alias("results")), {"pretty": "true"})
    runs.select(F.concat(F.lit("session_"), "batch").alias("name"), text.alias("value")).repartition("name", "value").write.partitionBy("name").option("lineSep", "\n\n").text(path)
    schema = T.StructType.fromDDL("session struct<name: string, batch: int>, results struct<chunk: bigint, items: array<struct<work: struct<id: bigint, stage: string>, seconds: double>>>")
    rows = d.read_runs(t.spark, f"{path}/name=session_[012]", schema).select("session.batch", F.explode("results.items").alias("i"))
    return rows.groupBy("batch", F.col("i.work.stage").alias("stage")).agg(F.count("*").alias("n"), F.round(F.sum("i.seconds"), 4).alias("seconds"))


@query("metrics_scan", "SELECT run, count(*) AS n, round(sum(seconds), 4) AS seconds FROM metrics WHERE batch IN (1, 2) GROUP BY run")
def metrics_scan(t):
    """Run metrics as JSON folders by batch, of which a pattern picks two."""
    path = shared_path(t.spark, "metrics")
    t.metrics.write.partitionBy("batch").json(path)
    rows = d.read_metrics(t.spark, f"{path}/batch=[12]", lines=True, schema=T.StructType.fromDDL("item bigint, run string, chunk bigint, seconds double"))
    return rows.groupBy("run").agg(F.count("*").alias("n"), F.round(F.sum("seconds"), 4).alias("seconds"))


@query("valid_party", "SELECT app_id, pos FROM contacts WHERE role IN ('A', 'N')")
def valid_party_(t):
    return valid_party(contacts(t, "con_id", "role"), "con_id", "role", ["A", "N"]).select(F.col("doc_id").alias("app_id"), F.col("contact_pos").alias("pos"))


@query("rule_filter", "SELECT app_id, pos FROM contacts WHERE role IN ('A', 'R')")
def rule_filter_(t):
    return rule_filter(contacts(t, "con_id", "role"), {"con_id": True, "role": ["a", "R"]}).select(F.col("doc_id").alias("app_id"), F.col("contact_pos").alias("pos"))
