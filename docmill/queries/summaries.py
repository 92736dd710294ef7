"""Profiles, run statistics and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import reconcile as rec
from ..operators import summarize as z
from ..plans.contract import Contract, Mapping, parse
from ..plans.dispatch import kv_side, kv_source, record_rows
from ..sources.staging import staged
from . import shredding as x
from .base import query

COLS = ["status_code", "priority_code", "amount", "zip"]


def per_column(sql: str, cols: list[str] = COLS) -> str:
    return " UNION ALL ".join(sql.format(c=c) for c in cols)


@query("null_profile", per_column("SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null FROM codes"))
def null_profile(t):
    return z.null_profile(t.codes, COLS)


@query(
    "adjacent_mismatch",
    "SELECT 'amount_zip' AS pair, count(*) FILTER (WHERE (amount IS NULL) <> (zip IS NULL)) AS mismatches FROM codes UNION "
    "ALL SELECT 'status_code_amount', count(*) FILTER (WHERE (status_code IS NULL) <> (amount IS NULL)) FROM codes",
)
def adjacent_mismatch(t):
    return z.pair_mismatch(t.codes, [("amount", "zip"), ("status_code", "amount")])


@query("enum_distribution", per_column("SELECT '{c}' AS column_name, {c} AS value, count(*) AS n FROM codes GROUP BY {c}", ["status_code", "priority_code", "state"]))
def enum_distribution(t):
    return z.value_counts(t.codes, ["status_code", "priority_code", "state"])


@query(
    "nonnull_histogram",
    "SELECT n_filled, count(*) AS n_rows FROM (SELECT CAST((status_code IS NOT NULL) AS INTEGER) + CAST((priority_code IS "
    "NOT NULL) AS INTEGER) + CAST((amount IS NOT NULL) AS INTEGER) + CAST((zip IS NOT NULL) AS INTEGER) AS n_filled FROM "
    "codes) x GROUP BY n_filled",
)
def nonnull_histogram(t):
    return z.nonnull_histogram(t.codes, COLS)


@query("population_pct", per_column("SELECT '{c}' AS column_name, round(100 * count({c}) / count(*), 1) AS pct FROM codes"))
def population_pct(t):
    return z.population_pct(t.codes, COLS)


@query(
    "table_counts",
    "SELECT (SELECT count(*) FROM orders) AS orders, (SELECT count(*) FROM lineitem) AS lineitem, (SELECT count(*) FROM "
    "customer) AS customer",
)
def table_counts(t):
    return z.table_counts({n: getattr(t, n) for n in ("orders", "lineitem", "customer")})


@query(
    "issue_counts",
    "SELECT count(*) FILTER (WHERE state = 'XX') AS bad_state, count(*) FILTER (WHERE zip = '00000') AS bad_zip, count(*) "
    "FILTER (WHERE amount IS NULL) AS no_amount FROM codes",
)
def issue_counts(t):
    return z.issue_counts(t.codes, {"bad_state": F.col("state") == "XX", "bad_zip": F.col("zip") == "00000", "no_amount": F.col("amount").isNull()})


@query(
    "session_rollup",
    "SELECT session_id, count(*) AS n, min(app_id) AS min_id, max(app_id) AS max_id, count(*) FILTER (WHERE status = "
    "'success') AS ok, count(*) FILTER (WHERE status = 'failed') AS failed FROM log GROUP BY session_id",
)
def session_rollup(t):
    return z.session_rollup(t.log)


@query("distinct_counts", "SELECT name, count(*) AS n, count(DISTINCT app_id) AS n_ids FROM stored GROUP BY name")
def distinct_counts(t):
    return z.distinct_counts(t.stored, "app_id", "name")


@query(
    "success_rate",
    "SELECT count(*) AS processed, count(*) FILTER (WHERE status = 'success') AS ok, count(*) FILTER (WHERE status = "
    "'failed') AS failed, round(100.0 * count(*) FILTER (WHERE status = 'success') / count(*), 2)::DOUBLE AS pct FROM log",
)
def success_rate(t):
    return z.success_rate(t.log).withColumn("pct", F.col("pct").cast("double"))


@query(
    "failure_by_stage",
    "WITH f AS (SELECT app_id, split_part(failure_reason, ':', 1) AS stage FROM log WHERE status = 'failed'), k AS (SELECT "
    "*, row_number() OVER (PARTITION BY stage ORDER BY app_id) AS r FROM f) SELECT stage, count(*) AS n, round(100.0 * "
    "count(*) / sum(count(*)) OVER (), 2)::DOUBLE AS pct, CAST(rank() OVER (ORDER BY count(*) DESC) AS INTEGER) AS rank, "
    "string_agg(CAST(app_id AS VARCHAR), ',' ORDER BY app_id) FILTER (WHERE r <= 5) AS examples FROM k GROUP BY stage",
)
def failure_by_stage(t):
    return z.failures_by_stage(t.log, 5).withColumn("pct", F.col("pct").cast("double"))


@query(
    "run_rollup",
    "SELECT sum(processed)::BIGINT AS processed, sum(successful)::BIGINT AS successful, max(seconds) AS seconds, "
    "round(sum(processed) * 60.0 / max(seconds), 4) AS per_minute FROM (SELECT batch, count(*) AS processed, count(*) "
    "FILTER (WHERE run <> 'error') AS successful, max(seconds) AS seconds FROM metrics GROUP BY batch) x",
)
def run_rollup(t):
    runs = t.metrics.groupBy("batch").agg(
        F.count("*").alias("processed"), F.count_if(F.col("run") != "error").alias("successful"), F.max("seconds").alias("seconds"),
    )
    return z.run_rollup(runs)


@query(
    "stage_stats",
    "SELECT run, batch, count(seconds) AS n, round(avg(seconds), 4) AS mean, round(quantile_cont(seconds, 0.5), 4) AS "
    "median, round(stddev_samp(seconds), 4) AS sd, CASE WHEN stddev_samp(seconds) / avg(seconds) < 0.1 THEN 'stable' WHEN "
    "stddev_samp(seconds) / avg(seconds) < 0.5 THEN 'varied' ELSE 'erratic' END AS spread FROM metrics GROUP BY run, batch",
)
def stage_stats(t):
    return z.stage_stats(t.metrics, ["run", "batch"], "seconds")


@query(
    "chunk_trend",
    "WITH c AS (SELECT run, chunk, sum(seconds) AS s FROM metrics GROUP BY run, chunk), k AS (SELECT *, ntile(3) OVER "
    "(PARTITION BY run ORDER BY chunk) AS third FROM c) SELECT run, round(avg(s), 6) AS mean, round(min(s), 6) AS least, "
    "round(max(s), 6) AS most, round(100 * (avg(s) FILTER (WHERE third = 3) - avg(s) FILTER (WHERE third = 1)) / avg(s) "
    "FILTER (WHERE third = 1), 6) AS change_pct FROM k GROUP BY run",
)
def chunk_trend(t):
    chunks = t.metrics.groupBy("run", "chunk").agg(F.sum("seconds").alias("s"))
    return z.chunk_trend(chunks, "run", "chunk", "s").withColumns({"least": F.round("least", 6), "most": F.round("most", 6)})


@query("efficiency", "SELECT run, round(sum(seconds) / (4 * max(seconds)), 6) AS efficiency FROM metrics GROUP BY run")
def efficiency(t):
    return z.efficiency(t.metrics, "run", "seconds", "seconds", 4)


@query(
    "key_collisions",
    "SELECT con_id, count(DISTINCT app_id) AS n_docs, min(app_id) AS first_doc, max(app_id) AS last_doc FROM contacts "
    "GROUP BY con_id HAVING count(DISTINCT app_id) > 1",
)
def key_collisions(t):
    return z.key_collisions(t.contacts, "con_id", "app_id")


@query(
    "collision_documents",
    "SELECT con_id, app_id, n_docs, nth FROM (SELECT con_id, app_id, count(*) OVER (PARTITION BY con_id) AS n_docs, row_number() OVER (PARTITION BY con_id ORDER BY app_id) AS nth "
    "FROM (SELECT DISTINCT con_id, app_id FROM contacts) c) d WHERE n_docs > 1",
)
def collision_documents(t):
    return z.collision_documents(t.contacts, "con_id", "app_id")


@query("never_populated", "SELECT 'codes' AS table_name, 'never' AS column_name FROM codes HAVING count(never) = 0")
def never_populated(t):
    return z.never_populated({"codes": t.codes, "log": t.log})


@query(
    "default_counts",
    "SELECT 'state' AS column_name, count(*) AS n, (SELECT string_agg(CAST(app_id AS VARCHAR), ',' ORDER BY CAST(app_id AS "
    "VARCHAR)) FROM (SELECT app_id FROM codes WHERE state = 'XX' ORDER BY app_id LIMIT 5) e) AS examples FROM codes WHERE "
    "state = 'XX' UNION ALL SELECT 'zip', count(*), (SELECT string_agg(CAST(app_id AS VARCHAR), ',' ORDER BY CAST(app_id "
    "AS VARCHAR)) FROM (SELECT app_id FROM codes WHERE zip = '00000' ORDER BY app_id LIMIT 5) e) FROM codes WHERE zip = "
    "'00000'",
)
def default_counts(t):
    return z.default_counts(t.codes, "app_id", {"state": "XX", "zip": "00000"}).select("column_name", "n", "examples")


@query(
    "gap_analysis",
    "WITH j AS (SELECT o_orderkey AS id, l.app_id AS l, s.app_id AS s FROM orders LEFT JOIN (SELECT DISTINCT app_id FROM "
    "log) l ON l.app_id = o_orderkey LEFT JOIN (SELECT DISTINCT app_id FROM stored) s ON s.app_id = o_orderkey) SELECT "
    "count(*) AS source_rows, count(l) AS logged, count(*) - count(l) AS gap, round(100.0 * (count(*) - count(l)) / "
    "count(*), 2)::DOUBLE AS gap_pct, min(id) FILTER (WHERE l IS NULL) AS gap_min, max(id) FILTER (WHERE l IS NULL) AS "
    "gap_max, count(*) FILTER (WHERE l IS NOT NULL AND s IS NOT NULL) AS with_scores, count(*) FILTER (WHERE l IS NOT NULL "
    "AND s IS NULL) AS without_scores FROM j",
)
def gap_analysis(t):
    out = rec.gap(t.orders.select(F.col("o_orderkey").alias("app_id")), t.log, t.stored, "app_id")
    return out.withColumn("gap_pct", F.col("gap_pct").cast("double"))


@query(
    "suspect_scan",
    "SELECT app_id, CASE WHEN state = 'XX' AND zip = '00000' THEN 'state,zip' WHEN state = 'XX' THEN 'state' ELSE 'zip' "
    "END AS reason FROM codes WHERE (state = 'XX' OR zip = '00000') AND app_id IN (SELECT app_id FROM contacts)",
)
def suspect_scan(t):
    return rec.suspects(t.codes, "app_id", {"state": ["XX", "MISSING"], "zip": ["00000"]}, t.contacts.select("app_id"))


@query(
    "suspect_scan_all",
    "WITH m AS (SELECT app_id, 'codes.state' AS reason FROM codes WHERE state IN ('XX', 'MISSING') UNION ALL SELECT app_id, 'codes.zip' FROM codes WHERE zip = '00000' UNION ALL SELECT app_id, "
    "'codes.priority_code' FROM codes WHERE priority_code = 'UNKNOWN' UNION ALL SELECT app_id, 'contact.line' FROM contacts WHERE line = 'F' AND role = 'R' UNION ALL SELECT app_id, 'log.status' FROM log WHERE "
    "status = 'failed' UNION ALL SELECT app_id, 'stored.name' FROM stored WHERE name = 'extra') SELECT app_id, count(*) AS n, string_agg(DISTINCT reason, ',' ORDER BY reason) AS reasons FROM m WHERE app_id IN "
    "(SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY app_id",
)
def suspect_scan_all(t):
    """Markers in four tables, merged by document."""
    source = t.orders.filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("app_id"))
    catalogue = {
        "codes": (t.codes, {"state": ["XX", "MISSING"], "zip": ["00000"], "priority_code": ["UNKNOWN"]}), "contact": (t.contacts.filter("role = 'R'"), {"line": ["F"]}),
        "log": (t.log, {"status": ["failed"]}), "stored": (t.stored, {"name": ["extra"]}),
    }
    return rec.suspects_over(catalogue, "app_id", source)


@query(
    "smell_verify",
    "SELECT app_id, 'state' AS field, CASE WHEN coalesce(trim(txt), '') <> '' THEN 'mapping failure' ELSE 'injected' END "
    "AS verdict FROM codes JOIN raw ON id = app_id WHERE state = 'XX' UNION ALL SELECT app_id, 'zip', CASE WHEN "
    "coalesce(trim(phone), '') <> '' THEN 'mapping failure' ELSE 'injected' END FROM codes JOIN raw ON id = app_id WHERE "
    "zip = '00000'",
)
def smell_verify(t):
    source = t.raw.select(F.col("id").alias("app_id"), "txt", "phone")
    return rec.verify_smells(t.codes, source, "app_id", {"state": ("txt", "XX"), "zip": ("phone", "00000")})


@query(
    "doc_verdict",
    "SELECT c.app_id, CASE WHEN c.app_id % 31 = 0 THEN 'FAIL' WHEN c.app_id NOT IN (SELECT app_id FROM contacts) OR "
    "c.app_id NOT IN (SELECT app_id FROM stored) OR (CAST((status_code IS NOT NULL) AS INTEGER) + CAST((amount IS NOT "
    "NULL) AS INTEGER)) / 2.0 < 0.15 OR (zip IS NULL) THEN 'WARN' ELSE 'PASS' END AS verdict FROM codes c",
)
def doc_verdict(t):
    src = t.codes.withColumn("has_source", F.col("app_id") % 31 != 0)
    filled = (F.col("status_code").isNotNull().cast("int") + F.col("amount").isNotNull().cast("int")) / 2.0
    return rec.doc_verdict(src, {"contacts": t.contacts, "stored": t.stored}, "app_id", filled, F.col("zip").isNull())


@query(
    "enum_verify",
    "SELECT app_id, CASE WHEN status_code IS NULL AND app_id % 4 = 0 THEN 'both empty' WHEN status_code IS NULL THEN "
    "'stored without source' WHEN status_code = 'P' THEN 'unknown code' WHEN app_id % 4 = 0 THEN 'not stored' WHEN app_id "
    "% 9 <> 0 THEN 'match' ELSE 'mismatch' END AS outcome FROM codes",
)
def enum_verify(t):
    code = F.when(F.col("status_code") == "F", 1).when(F.col("status_code") == "O", 2)
    rows = t.codes.withColumn("kept", F.when(F.col("app_id") % 4 != 0, F.coalesce(code, F.lit(0)) + F.when(F.col("app_id") % 9 == 0, 10).otherwise(0)))
    return rec.verify_enum(rows, "app_id", "status_code", "kept", code)


@query(
    "enum_column_audit",
    "SELECT 'status_code' AS column_name, count(*) AS n_rows, count(*) - count(status_code) AS n_null, count(*) FILTER "
    "(WHERE status_code NOT IN ('F', 'O')) AS n_unknown, 'OK' AS state FROM codes UNION ALL SELECT 'never', count(*), "
    "count(*), 0, 'NEVER POPULATED' FROM codes",
)
def enum_column_audit(t):
    return rec.audit_enums(t.codes, {"status_code": ["F", "O"], "never": ["x"]})


@query(
    "source_first_scores",
    "WITH j AS (SELECT e.value AS v, s.value AS w, s.app_id AS a, l.app_id AS l FROM expected e LEFT JOIN (SELECT DISTINCT "
    "app_id FROM log) l ON l.app_id = e.app_id LEFT JOIN stored s ON s.app_id = e.app_id AND s.name = e.name) SELECT "
    "count(*) AS expected, round(100.0 * count(l) / count(*), 2)::DOUBLE AS coverage, round(100.0 * count(*) FILTER (WHERE "
    "l IS NOT NULL AND a IS NOT NULL) / count(l), 2)::DOUBLE AS completeness, round(100.0 * count(*) FILTER (WHERE l IS "
    "NOT NULL AND a IS NOT NULL AND v = w) / count(*) FILTER (WHERE l IS NOT NULL AND a IS NOT NULL), 2)::DOUBLE AS "
    "accuracy FROM j",
)
def source_first_scores(t):
    out = rec.source_first(t.expected, t.stored, t.log, ["app_id", "name"], "value")
    return out.select("expected", *[F.col(c).cast("double").alias(c) for c in ("coverage", "completeness", "accuracy")])


@query(
    "source_first_slots",
    "SELECT e.app_id, e.n AS n_expected, coalesce(s.n, 0) AS n_stored FROM (SELECT app_id, count(*) AS n FROM expected "
    "GROUP BY app_id) e LEFT JOIN (SELECT app_id, count(*) AS n FROM stored GROUP BY app_id) s ON s.app_id = e.app_id "
    "WHERE e.n <> coalesce(s.n, 0)",
)
def source_first_slots(t):
    return rec.source_first_counts(t.expected, t.stored, "app_id")


@query(
    "kv_reconcile",
    "SELECT coalesce(e.app_id, s.app_id) AS app_id, coalesce(e.name, s.name) AS name, e.value AS mapped, s.value AS "
    "stored, CASE WHEN e.app_id IS NULL THEN 'WARN extra' WHEN s.app_id IS NULL THEN 'FAIL missing' WHEN e.value = s.value "
    "THEN 'PASS' ELSE 'FAIL differs' END AS outcome FROM expected e FULL JOIN stored s ON e.app_id = s.app_id AND e.name = "
    "s.name",
)
def kv_reconcile(t):
    return rec.reconcile(t.expected, t.stored, ["app_id", "name"], "value")


RAW = "CASE WHEN id % 3 <> 1 THEN CAST(id % 850 AS BIGINT) END"
NUMBER = "CAST(round(try_cast(trim(num) AS DECIMAL(28,6)), 0) AS BIGINT)"
KV_SQL = (
    f"WITH s AS (SELECT id AS doc_id, 'scores' AS table_name, 'A_SCORE' AS name, CAST(NULL AS STRING) AS source, 'score_a' AS attribute, trim(num) AS raw, CAST({NUMBER} AS STRING) AS expected FROM raw "
    f"UNION ALL SELECT id, 'scores', 'B_SCORE', NULL, 'score_b', CAST({RAW} AS STRING), CAST({RAW} AS STRING) FROM raw "
    f"UNION ALL SELECT id, 'history', '[score_b]', '[application]', 'score_b', CAST({RAW} AS STRING), CAST({RAW} AS STRING) FROM raw), "
    "m AS (SELECT doc_id, table_name, name, source, CASE WHEN doc_id % 37 = 0 THEN concat(expected, '9') ELSE expected END AS mapped FROM s WHERE expected IS NOT NULL AND doc_id % 13 <> 0 "
    "UNION ALL SELECT id, 'scores', 'C_SCORE', NULL, '5' FROM raw WHERE id % 41 = 0), "
    "d AS (SELECT doc_id, table_name, name, source, CASE WHEN doc_id % 23 = 0 THEN concat(expected, '1') ELSE expected END AS stored FROM s WHERE expected IS NOT NULL AND doc_id % 10 <> 3 AND doc_id % 26 <> 0 "
    "UNION ALL SELECT id, 'history', '[other]', '[application]', 'x' FROM raw WHERE id % 29 = 0), "
    "k AS (SELECT doc_id, table_name, name, source FROM s UNION SELECT doc_id, table_name, name, source FROM m UNION SELECT doc_id, table_name, name, source FROM d), "
    "j AS (SELECT k.*, s.attribute, s.raw, s.expected, m.mapped, d.stored, m.doc_id IS NOT NULL AS has_m, d.doc_id IS NOT NULL AS has_d FROM k "
    "LEFT JOIN s ON s.doc_id = k.doc_id AND s.table_name = k.table_name AND s.name = k.name AND s.source IS NOT DISTINCT FROM k.source "
    "LEFT JOIN m ON m.doc_id = k.doc_id AND m.table_name = k.table_name AND m.name = k.name AND m.source IS NOT DISTINCT FROM k.source "
    "LEFT JOIN d ON d.doc_id = k.doc_id AND d.table_name = k.table_name AND d.name = k.name AND d.source IS NOT DISTINCT FROM k.source), "
    "o AS (SELECT *, CASE WHEN expected IS NOT NULL AND stored = expected AND mapped = expected THEN 1 WHEN expected IS NOT NULL AND stored = expected THEN 2 WHEN expected IS NOT NULL AND has_d THEN 3 "
    "WHEN expected IS NOT NULL AND mapped = expected THEN 4 WHEN expected IS NOT NULL THEN 5 WHEN has_d THEN 6 WHEN has_m THEN 7 WHEN trim(raw) <> '' THEN 8 ELSE 9 END AS c FROM j) "
    "SELECT doc_id, table_name, name, source, attribute, expected, mapped, stored, CASE WHEN c IN (1, 2, 9) THEN 'PASS' WHEN c <= 5 THEN 'FAIL' ELSE 'WARN' END AS outcome, "
    "CASE c WHEN 2 THEN 'not mapped' WHEN 3 THEN 'differs' WHEN 4 THEN 'not stored' WHEN 5 THEN 'not mapped' WHEN 6 THEN 'extra' WHEN 7 THEN 'mapped without source' WHEN 8 THEN 'value gives no row' "
    "WHEN 9 THEN 'nothing to store' END AS cause, CASE WHEN attribute = 'score_b' AND expected = '0' THEN 'zero score' WHEN expected IS NOT NULL AND has_m AND coalesce(mapped <> expected, TRUE) THEN "
    "'mapped value differs' END AS smell FROM o"
)


KV = Contract(x.ROOT, x.APP, [x.CONTACT], [
    Mapping(x.APP, "score_a", "scores", "", "int", None, ["add_score(A_SCORE)"]), Mapping(x.APP, "score_b", "scores", "", "int", None, ["add_score(B_SCORE)"]),
    Mapping(x.APP, "score_b", "history", "", "string", None, ["add_history"]),
])


def three_sides(t):
    """The source by contract, and mapped and stored rows that differ from it by rule."""
    rows = staged(parse(x.documents(t), KV), "kv-documents")
    at = {"/Envelope/Request": "d.Request", x.APP: "d.Request.CustData.application"}
    source = kv_source(rows, KV, ["scores", "history"], at)
    made = [kv_side(record_rows(rows, KV, n, at), n) for n in ("scores", "history")]
    all_ = made[0].unionByName(made[1])
    key = lambda n, table, name, origin, value: t.raw.filter(F.col("id") % n == 0).select(F.col("id").alias("doc_id"), F.lit(table).alias("table_name"), F.lit(name).alias("name"), F.lit(origin).cast("string").alias("source"), F.lit(value).alias("value"))
    changed = lambda n, tail: F.when(F.col("doc_id") % n == 0, F.concat("value", F.lit(tail))).otherwise(F.col("value"))
    mapped = all_.filter("doc_id % 13 <> 0").withColumn("value", changed(37, "9")).unionByName(key(41, "scores", "C_SCORE", None, "5"))
    stored = all_.filter("doc_id % 10 <> 3 and doc_id % 26 <> 0").withColumn("value", changed(23, "1")).unionByName(key(29, "history", "[other]", "[application]", "x"))
    return rec.reconcile_source(source, mapped, stored, ["doc_id", "table_name", "name", "source"], "score_b")


@query("kv_reconcile_source", KV_SQL)
def kv_reconcile_source(t):
    """Source, mapped and stored rows side by side: outcome, cause and smells of each mapping."""
    return three_sides(t)


@query(
    "kv_reconcile_summary",
    f"SELECT table_name, outcome, cause, smell, count(*) AS n, min(doc_id) AS first_id, max(doc_id) AS last_id FROM ({KV_SQL}) x GROUP BY table_name, outcome, cause, smell",
)
def kv_reconcile_summary(t):
    return rec.outcome_counts(three_sides(t), ["table_name"])


@query(
    "kv_missing",
    "SELECT e.* FROM expected e WHERE app_id IN (SELECT app_id FROM log WHERE status = 'success') AND NOT EXISTS (SELECT 1 "
    "FROM stored s WHERE s.app_id = e.app_id AND s.name = e.name)",
)
def kv_missing(t):
    return rec.missing_rows(t.expected, t.stored, t.log, ["app_id", "name"]).select("app_id", "name", "value")


@query(
    "collision_winner",
    "SELECT DISTINCT c.con_id, c.app_id AS loser, w.owner FROM contacts c JOIN (SELECT con_id, min(app_id) AS owner FROM "
    "contacts GROUP BY con_id) w ON w.con_id = c.con_id WHERE c.app_id <> w.owner",
)
def collision_winner(t):
    kept = t.contacts.groupBy("con_id").agg(F.min("app_id").alias("app_id"))
    return rec.collision_winner(t.contacts, kept, "con_id", "app_id").select("con_id", "loser", "owner")


@query(
    "log_consistency",
    "SELECT (SELECT count(*) FROM orders) AS n_base, (SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT app_id "
    "FROM log)) AS n_unlogged, (SELECT count(*) FROM log WHERE status = 'success') AS n_success",
)
def log_consistency(t):
    return rec.log_consistency(t.orders.select(F.col("o_orderkey").alias("app_id")), t.log, "app_id")
