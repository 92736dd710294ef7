"""Sinks and incremental runs: the state of tables after a write."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bucketed as b
from ..operators import sinks as s
from ..sources.staging import shared_path
from ..streaming import incremental as inc
from . import shredding as x
from .base import query


@query(
    "column_union",
    "SELECT o_orderkey AS id, o_totalprice AS price, CAST(NULL AS STRING) AS name FROM orders UNION ALL SELECT c_custkey, "
    "NULL, c_name FROM customer",
)
def column_union(t):
    return s.union_columns(
        t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price")),
        t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")),
    )


@query(
    "insert_if_absent",
    "SELECT app_id, name, value FROM stored UNION ALL SELECT app_id, name, value + 1000 FROM expected e WHERE NOT EXISTS "
    "(SELECT 1 FROM stored s WHERE s.app_id = e.app_id AND s.name = e.name)",
)
def insert_if_absent(t):
    return s.insert_absent(t.expected.withColumn("value", F.col("value") + 1000), t.stored, ["app_id", "name"]).select("app_id", "name", "value")


@query(
    "kv_upsert",
    "SELECT coalesce(e.app_id, s.app_id) AS app_id, coalesce(e.name, s.name) AS name, coalesce(CASE WHEN e.app_id % 3 <> 0 "
    "THEN e.value END, s.value) AS value FROM expected e FULL JOIN stored s ON e.app_id = s.app_id AND e.name = s.name",
)
def kv_upsert(t):
    new = t.expected.withColumn("value", F.when(F.col("app_id") % 3 != 0, F.col("value")))
    return s.upsert(new, t.stored, ["app_id", "name"], ["value"])


@query(
    "insert_only_backfill",
    "SELECT app_id, name, value FROM stored UNION ALL SELECT app_id, name, value FROM expected e WHERE NOT EXISTS (SELECT "
    "1 FROM stored s WHERE s.app_id = e.app_id AND s.name = e.name)",
)
def insert_only_backfill(t):
    return s.backfill(t.expected.select("app_id", "name", "value"), t.stored.select("app_id", "name", "value"), ["app_id", "name"], apply=True)


def tables(t):
    ids = t.orders.select(F.col("o_orderkey").alias("doc_id"), "o_orderstatus")
    contacts = t.contacts.select(F.col("app_id").alias("doc_id"), "con_id", "pos")
    return {"contact": contacts, "app_base": ids, "other": t.codes.select(F.col("app_id").alias("doc_id"), "zip")}


@query(
    "ordered_write",
    "SELECT 'app_base' AS name, 1 AS nth, (SELECT count(*) FROM orders) AS n UNION ALL SELECT 'contact', 2, (SELECT "
    "count(*) FROM lineitem) UNION ALL SELECT 'other', 3, (SELECT count(*) FROM orders)",
)
def ordered_write(t):
    path = shared_path(t.spark, "tables")
    names = s.write_tables(tables(t), ["app_base", "contact"], path)
    counts = [t.spark.read.parquet(f"{path}/{n}").agg(F.lit(n).alias("name"), F.lit(i).alias("nth"), F.count("*").alias("n")) for i, n in enumerate(names, 1)]
    return s.union_columns(*counts)


@query("atomic_documents", "SELECT l_orderkey AS doc_id, count(*) AS n FROM lineitem WHERE l_orderkey % 6 <> 0 GROUP BY l_orderkey")
def atomic_documents(t):
    """Each sixth document fails; none of its rows is seen."""
    path = shared_path(t.spark, "commit")
    ids = t.orders.select(F.col("o_orderkey").alias("doc_id"))
    failed = ids.filter("doc_id % 6 = 0").withColumns({"stage": F.lit("mapping"), "message": F.lit("no value")})
    log = s.log_outcomes(ids.filter("doc_id % 6 <> 0"), failed, "s1")
    s.commit_documents(tables(t), failed, log, ["app_base", "contact"], path)
    return s.visible(t.spark, path, "contact").groupBy("doc_id").agg(F.count("*").alias("n"))


@query(
    "log_outcomes",
    "SELECT o_orderkey AS app_id, CASE WHEN o_orderkey % 6 = 0 THEN 'failed' ELSE 'success' END AS status, CASE WHEN "
    "o_orderkey % 6 = 0 THEN substr(concat('mapping: ', repeat('x', 600)), 1, 500) END AS failure_reason, 's1' AS "
    "session_id FROM orders",
)
def log_outcomes(t):
    ids = t.orders.select(F.col("o_orderkey").alias("doc_id"))
    failed = ids.filter("doc_id % 6 = 0").withColumns({"stage": F.lit("mapping"), "message": F.repeat(F.lit("x"), F.lit(600))})
    return s.log_outcomes(ids.filter("doc_id % 6 <> 0"), failed, "s1")


@query(
    "pk_exists_is_success",
    "SELECT app_id, CASE WHEN app_id IN (SELECT app_id FROM stored) THEN 'success' ELSE 'failed' END AS status FROM log "
    "WHERE status = 'failed'",
)
def pk_exists_is_success(t):
    return s.reclassify(t.log.filter("status = 'failed'"), t.stored, "app_id").select("app_id", "status")


@query(
    "delete_ids",
    "SELECT 'contact' AS name, count(*) AS n FROM contacts WHERE app_id % 9 <> 0 UNION ALL SELECT 'supplier', count(*) "
    "FROM supplier WHERE s_suppkey NOT IN (SELECT supp FROM contacts WHERE app_id % 9 = 0)",
)
def delete_ids(t):
    """Contacts of the documents go, and the suppliers that they name."""
    ids = t.orders.select(F.col("o_orderkey").alias("app_id")).filter("app_id % 9 = 0")
    left = s.delete_ids({"contact": t.contacts, "supplier": t.supplier.withColumnRenamed("s_suppkey", "supp")}, ids, "app_id", {"supplier": ("contact", "supp")})
    return s.union_columns(*[df.agg(F.lit(n).alias("name"), F.count("*").alias("n")) for n, df in left.items()])


@query("export_failures", "SELECT app_id, split_part(failure_reason, ':', 1) AS stage FROM log WHERE status = 'failed'")
def export_failures(t):
    path = shared_path(t.spark, "failures")
    s.export_failures(t.log, path)
    back = t.spark.read.schema("app_id bigint, stage string").json(f"{path}/json")
    return back.select("app_id", "stage")


@query("incremental_shred", x.BASE_SQL)
def incremental_shred(t):
    """Documents as a stream of files, shredded by contract; the same rows as in one batch."""
    docs, out = shared_path(t.spark, "stream-in"), shared_path(t.spark, "stream-out")
    source = x.documents(t)
    # groups of 16 MB, so a batch of few files is still read by many tasks
    source.write.options(**{"compression": "zstd", "parquet.block.size": 16 << 20}).parquet(docs)

    def process(df):
        rows = x.parse(df, x.CONTRACT)
        return x.table(rows, x.CONTRACT, "app_base", {"/Envelope/Request": "d.Request", x.APP: "d.Request.CustData.application"}, [])

    inc.stream_shred(t.spark, docs, source.schema, process, out, shared_path(t.spark, "stream-log"))
    return t.spark.read.parquet(out).drop("batch").withColumn("amount", F.col("amount").cast("double"))


@query("stream_dedupe", "SELECT o_orderkey AS doc_id FROM orders")
def stream_dedupe(t):
    """Each document is sent twice, in other files; each comes out once."""
    docs, out = shared_path(t.spark, "twice-in"), shared_path(t.spark, "twice-out")
    ids = t.orders.select(F.col("o_orderkey").alias("doc_id"))
    ids.write.parquet(docs)
    sent = len(t.spark.read.schema(ids.schema).parquet(docs).inputFiles())
    ids.write.mode("append").parquet(docs)
    inc.stream_dedupe(t.spark, docs, ids.schema, out, shared_path(t.spark, "twice-log"), files_per_batch=max(1, sent))
    return t.spark.read.parquet(out).select("doc_id")


@query("stream_dedupe_bounded", "SELECT o_orderkey AS doc_id FROM orders")
def stream_dedupe_bounded(t):
    """Each document is sent again with an event time a day later; ids are forgotten after a month of event time."""
    docs, out = shared_path(t.spark, "timed-in"), shared_path(t.spark, "timed-out")
    sent = t.orders.select(F.col("o_orderkey").alias("doc_id"), F.col("o_orderdate").cast("timestamp").alias("at"))
    both = sent.unionByName(sent.withColumn("at", F.col("at") + F.expr("INTERVAL 1 DAY")))
    cuts = ["1000-01-01", "1994-01-01", "1996-01-01", "9999-01-01"]
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):  # files come in the order of their event times
        both.filter((F.col("at") >= lo) & (F.col("at") < hi)).coalesce(4).write.mode("append").parquet(docs)
    inc.stream_dedupe(t.spark, docs, both.schema, out, shared_path(t.spark, "timed-log"), files_per_batch=4, event_time="at", late="30 days")
    return t.spark.read.parquet(out).select("doc_id")


def bucketed(t, df, keys):
    return b.Bucketed(t.spark, shared_path(t.spark, "bucketed"), keys, 16).create(df)


AGAIN = "app_id IN (SELECT app_id FROM log WHERE status = 'failed')"


@query(
    "bucket_upsert",
    f"WITH n AS (SELECT app_id, name, CASE WHEN app_id % 3 <> 0 THEN value + 5 END AS value FROM expected WHERE {AGAIN}) SELECT coalesce(n.app_id, s.app_id) AS app_id, coalesce(n.name, s.name) AS name, "
    "coalesce(n.value, s.value) AS value FROM n FULL JOIN stored s ON n.app_id = s.app_id AND n.name = s.name",
)
def bucket_upsert(t):
    """Documents that failed are mapped again; only their buckets are rewritten."""
    table = bucketed(t, t.stored.select("app_id", "name", "value"), ["app_id", "name"])
    again = t.expected.join(t.log.filter("status = 'failed'").select("app_id"), "app_id", "left_semi")
    table.upsert(again.select("app_id", "name", F.when(F.col("app_id") % 3 != 0, F.col("value") + 5).alias("value")), ["value"])
    return table.read()


@query(
    "bucket_insert",
    "SELECT con_id, app_id, pos FROM (SELECT con_id, app_id, pos, row_number() OVER (PARTITION BY con_id ORDER BY app_id IN (SELECT app_id FROM log WHERE status = 'success') DESC, app_id, pos) AS k FROM contacts "
    "WHERE app_id IN (SELECT app_id FROM log)) c WHERE k = 1",
)
def bucket_insert(t):
    """Contacts of successful documents, then those of failed ones: a key that is there stays with its first writer, in a batch and across batches."""
    def of(status):
        return t.contacts.join(t.log.filter(F.col("status") == status).select("app_id"), "app_id", "left_semi").select("con_id", "app_id", "pos")

    table = bucketed(t, of("success").limit(0), ["con_id"])
    for status in ("success", "failed"):
        table.insert_absent(of(status), "app_id", "pos")
    return table.read()


@query(
    "bucket_backfill",
    "SELECT app_id, name, value FROM stored UNION ALL SELECT app_id, name, value FROM expected e WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.app_id = e.app_id AND s.name = e.name)",
)
def bucket_backfill(t):
    """Only what is missing is appended; running it again adds nothing."""
    table = bucketed(t, t.stored.select("app_id", "name", "value"), ["app_id", "name"])
    for _ in range(2):
        table.backfill(t.expected.select("app_id", "name", "value"), apply=True)
    return table.read()


@query(
    "bucket_delete",
    f"SELECT 'base' AS name, o_orderkey AS key FROM orders WHERE NOT (o_orderkey IN (SELECT app_id FROM log WHERE status = 'failed')) UNION ALL SELECT 'contact', app_id FROM contacts WHERE NOT ({AGAIN}) "
    f"UNION ALL SELECT 'supplier', s_suppkey FROM supplier WHERE s_suppkey NOT IN (SELECT supp FROM contacts WHERE {AGAIN})",
)
def bucket_delete(t):
    """Failed documents go from all tables, and the suppliers that their contacts name."""
    base = bucketed(t, t.orders.select(F.col("o_orderkey").alias("app_id"), "o_orderstatus"), ["app_id"])
    contact = bucketed(t, t.contacts.select("app_id", "pos", "supp"), ["app_id"])
    supplier = bucketed(t, t.supplier.select(F.col("s_suppkey").alias("supp"), "s_name"), ["supp"])
    all_ = {"base": base, "contact": contact, "supplier": supplier}
    b.delete_ids(all_, t.log.filter("status = 'failed'").select("app_id"), "app_id", {"supplier": ("contact", "supp")})
    return s.union_columns(*[x.read().select(F.lit(n).alias("name"), F.col(x.keys[0]).alias("key")) for n, x in all_.items()])
