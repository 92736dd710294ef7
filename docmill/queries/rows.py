"""Row-creating mappings, filters of mapped rows, and picking one of several."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import filters as f
from ..operators import pick as p
from ..operators import rows as r
from .base import query


@query(
    "kv_scores",
    "SELECT id, 'score_num' AS score_identifier, CAST(round(try_cast(trim(num) AS DECIMAL(28,6)), 0) AS INTEGER) AS score "
    "FROM raw WHERE try_cast(trim(num) AS DECIMAL(28,6)) IS NOT NULL UNION ALL SELECT id, 'score_p', CAST(round(CAST(p AS "
    "DECIMAL(28,6)), 0) AS INTEGER) FROM raw",
)
def kv_scores(t):
    return r.kv_rows(t.raw, "id", [("num", "score_num"), ("p", "score_p")], "score")


@query("kv_indicators", "SELECT id, 'signed' AS indicator, '1' AS value FROM raw WHERE lower(trim(flag)) IN ('y', 'yes', 'true', 't', '1')")
def kv_indicators(t):
    return r.kv_rows(t.raw, "id", [("flag", "signed"), ("txt", "text")], "indicator")


@query(
    "kv_history",
    "SELECT id, '[txt]' AS name, '[application]' AS source, trim(txt) AS value FROM raw WHERE lower(trim(txt)) NOT IN ('', "
    "'null', 'none') UNION ALL SELECT id, '[phone]', '[contact]', trim(phone) FROM raw WHERE lower(trim(phone)) NOT IN "
    "('', 'null', 'none')",
)
def kv_history(t):
    return r.kv_rows(t.raw, "id", [("txt", "application"), ("phone", "contact")], "history")


@query(
    "kv_report_lookup",
    "SELECT id, 'report_text' AS name, trim(txt) AS value FROM raw WHERE lower(trim(txt)) NOT IN ('', 'null', 'none') "
    "UNION ALL SELECT id, 'report_mail', trim(email) FROM raw WHERE email IS NOT NULL",
)
def kv_report_lookup(t):
    return r.kv_rows(t.raw, "id", [("txt", "report_text"), ("email", "report_mail")], "report")


@query(
    "group_policy",
    "SELECT id, 501 AS type, num AS reason, pr AS notes FROM raw WHERE coalesce(trim(num), '') <> '' UNION ALL SELECT id, "
    "502, email, pr FROM raw WHERE email IS NOT NULL",
)
def group_policy(t):
    """A row for each exception that has a reason; the notes are the document's."""
    return r.group_rows(t.raw, "id", {501: {"reason": F.col("num")}, 502: {"reason": F.col("email")}}, ["reason"], {"notes": F.col("pr")})


@query(
    "group_warranty",
    "SELECT id, 601 AS type, num AS amount, txt AS company, coalesce(CASE WHEN flag = 'Y' THEN 1 END, 0) AS lien FROM raw "
    "WHERE coalesce(trim(num), '') <> '' OR coalesce(trim(txt), '') <> '' UNION ALL SELECT id, 602, NULL, phone, 0 FROM "
    "raw WHERE coalesce(trim(phone), '') <> ''",
)
def group_warranty(t):
    lien = F.when(F.col("flag") == "Y", 1)
    none = F.lit(None)
    return r.group_rows(
        t.raw, "id",
        {601: {"amount": F.col("num"), "company": F.col("txt"), "lien": lien}, 602: {"amount": none.cast("string"), "company": F.col("phone"), "lien": none.cast("int")}},
        ["amount", "company"], None, {"lien": 0},
    )


@query(
    "group_slots",
    "SELECT app_id AS id, pos + 1 AS sort_order, con_id AS make, CASE WHEN con_id % 3 = 0 THEN 0.0 ELSE amount END AS "
    "value, coalesce(CASE WHEN n > 3 THEN 1 END, 0) AS used FROM contacts WHERE pos < 4 AND (con_id % 5 <> 0 OR con_id % 3 "
    "<> 0) ",
)
def group_slots(t):
    """The first four contacts as numbered slots; each fifth has no make, each third an amount of 0, which alone makes no row."""
    wide = t.contacts.filter("pos < 4").groupBy(F.col("app_id").alias("id")).pivot("pos", [0, 1, 2, 3]).agg(
        F.first("con_id").alias("c"), F.first("amount").alias("a"), F.first("n").alias("n"),
    )
    slots = []
    for i in range(4):
        c = F.col(f"{i}_c")
        slots.append({"make": F.when(c % 5 != 0, c), "value": F.when(c % 3 == 0, 0.0).otherwise(F.col(f"{i}_a")), "used": F.when(F.col(f"{i}_n") > 3, 1), "raw": c})
    rows = r.slot_rows(wide, "id", slots, ["make"], "value", {"used": 0})
    return rows.select("id", "sort_order", F.col("raw").alias("make"), "value", "used")


@query("meaningful_contact", "SELECT id FROM raw WHERE coalesce(trim(num), '') <> '' OR coalesce(trim(txt), '') <> '' OR coalesce(trim(email), '') <> ''")
def meaningful_contact(t):
    return f.any_nonblank(t.raw, ["num", "txt", "email"]).select("id")


@query("meaningful_address", "SELECT app_id FROM codes WHERE zip IS NOT NULL OR amount IS NOT NULL")
def meaningful_address(t):
    return f.any_nonblank(t.codes, ["zip", "amount"]).select("app_id")


@query("meaningful_employment", "SELECT id FROM raw WHERE coalesce(trim(phone), '') <> '' OR coalesce(trim(flag), '') <> ''")
def meaningful_employment(t):
    return f.any_nonblank(t.raw, ["phone", "flag"]).select("id")


@query("skip_default_only", "SELECT app_id FROM codes WHERE state <> 'OH' OR amount IS NOT NULL")
def skip_default_only(t):
    """A state of OH is a default here; rows with nothing else go."""
    rows = t.codes.withColumn("state_defaulted", F.col("state") == "OH")
    return f.drop_default_only(rows, {"state": "state_defaulted", "amount": None}).select("app_id")


@query(
    "conditional_default",
    "SELECT app_id, CASE WHEN (CASE WHEN zip IS NULL THEN 0 ELSE 1 END) + (CASE WHEN amount IS NULL THEN 0 ELSE 1 END) + "
    "(CASE WHEN status_code IS NULL THEN 0 ELSE 1 END) >= 2 THEN state END AS state FROM codes",
)
def conditional_default(t):
    return f.blank_conditional(t.codes, ["zip", "amount", "status_code"], ["state"]).select("app_id", "state")


@query("default_tracking", "SELECT id, coalesce(trim(txt), '') = '' AS defaulted FROM raw")
def default_tracking(t):
    out = F.coalesce(F.nullif(F.trim("txt"), F.lit("")), F.lit("none given"))
    return t.raw.select("id", f.defaulted(F.col("txt"), out, "none given").alias("defaulted"))


@query("search_predicate", "SELECT id FROM raw WHERE CAST(id AS STRING) = '1' OR upper(pr) LIKE '1%' OR right(ssn, 4) = '1' OR upper(st) LIKE '%1%'")
def search_predicate(t):
    return f.quick_search(t.raw, "1", ["id"], ["pr"], {"ssn": 4}, ["st"]).select("id")


LAST = "SELECT app_id, con_id FROM (SELECT *, row_number() OVER (PARTITION BY app_id ORDER BY pos DESC) AS k FROM contacts WHERE {}) x WHERE k = 1"


@query("last_valid_primary", LAST.format("role = 'A' AND con_id % 7 <> 0"))
def last_valid_primary(t):
    rows = t.contacts.withColumn("ok", F.when(F.col("con_id") % 7 != 0, F.col("con_id")))
    return p.last_of_type(rows, "app_id", "role", "A", "con_id", "pos", "ok")


@query("last_valid_secondary", LAST.format("role = 'N' AND con_id % 7 <> 0"))
def last_valid_secondary(t):
    rows = t.contacts.withColumn("ok", F.when(F.col("con_id") % 7 != 0, F.col("con_id")))
    return p.last_of_type(rows, "app_id", "role", "N", "con_id", "pos", "ok")


@query("last_authorized", LAST.format("role = 'N'"))
def last_authorized(t):
    return p.last_of_type(t.contacts, "app_id", "role", "N", "con_id", "pos")


@query("preferred_address", "SELECT app_id, pos, CASE WHEN line = 'O' THEN supp END AS supp FROM contacts")
def preferred_address(t):
    """The last address of the current type of each contact, from its array of addresses."""
    a = F.array(
        F.struct(F.lit("PREV").alias("type"), F.lit(0).cast("bigint").alias("supp")),
        F.struct(F.when(F.col("line") == "O", "CURR").otherwise("PREV").alias("type"), F.col("supp")),
    )
    return t.contacts.select("app_id", "pos", p.preferred_child(a, "type", "CURR")["supp"].alias("supp"))


@query("history_fallback", LAST.format("con_id % 3 <> 0").replace("con_id FROM (", "con_id AS value FROM ("))
def history_fallback(t):
    rows = t.contacts.withColumn("value", F.when(F.col("con_id") % 3 != 0, F.col("con_id")))
    return p.last_nonblank(rows, "app_id", "value", "pos")


@query(
    "priority_dedupe",
    "SELECT app_id, con_id, role, pos FROM (SELECT *, row_number() OVER (PARTITION BY app_id, con_id ORDER BY CASE role "
    "WHEN 'N' THEN 1 WHEN 'A' THEN 2 ELSE 999 END, pos DESC) AS k FROM contacts) x WHERE k = 1",
)
def priority_dedupe(t):
    return p.dedupe_priority(t.contacts, ["app_id", "con_id"], "role", ["N", "A"], "pos").select("app_id", "con_id", "role", "pos")


@query("last_by_key", "SELECT app_id, role, max(pos) AS pos FROM contacts GROUP BY app_id, role")
def last_by_key(t):
    return p.keep_last(t.contacts, ["app_id", "role"], "pos").select("app_id", "role", "pos")


@query("first_in_batch", "SELECT con_id, role, min(app_id) AS app_id FROM contacts GROUP BY con_id, role")
def first_in_batch(t):
    return p.keep_first(t.contacts, ["con_id", "role"], "app_id", "pos").select("con_id", "role", "app_id")


@query("latest_source", "SELECT user_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def latest_source(t):
    return p.latest(t.events, "user_id", "event_id", "event_type")


@query("max_id_group", "SELECT app_id, max(con_id) AS con_id FROM contacts GROUP BY app_id")
def max_id_group(t):
    return p.max_per(t.contacts, "app_id", "con_id")
