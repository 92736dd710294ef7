"""Casts and scalar mappings over raw text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import casts as c
from ..operators import quality
from ..plans import contract as k
from .base import query


def over_raw(key: str, column: str, sql: str, build) -> None:
    """A query (id, out) over the raw texts."""

    @query(key, f"SELECT id, {sql} AS out FROM raw")
    def run(t, build=build):
        return t.raw.select("id", build(F.col(column)).alias("out"))


NUM = "try_cast(replace(trim(num), ',', '') AS DECIMAL(28,6))"
over_raw("cast_int", "num", f"CAST(round({NUM}, 0) AS INTEGER)", lambda x: c.to_int(x))
over_raw("cast_decimal", "num", f"CAST(round({NUM}, 2) AS DOUBLE)", lambda x: c.to_decimal(x).cast("double"))
over_raw("cast_float", "num", "try_cast(trim(num) AS DOUBLE)", lambda x: c.to_double(x))
over_raw(
    "parse_datetime",
    "dt",
    "CASE id % 6 WHEN 0 THEN concat(d, ' 08:46:18.550') WHEN 1 THEN concat(d, ' 00:00:00.000') WHEN 2 THEN concat(d, ' "
    "00:00:00.000') WHEN 3 THEN concat(d, ' 13:05:09.000') WHEN 4 THEN concat(d, ' 23:59:59.000') END",
    lambda x: F.date_format(c.to_datetime(x), "yyyy-MM-dd HH:mm:ss.SSS"),
)
over_raw("clamp_seconds", "dt", "CASE WHEN id % 6 = 4 THEN replace(dt, ':88', ':59') ELSE dt END", c.clamp_seconds)
over_raw("cast_bit", "flag", "CASE WHEN coalesce(trim(flag), '') <> '' THEN 1 ELSE 0 END", c.to_bit)
over_raw("cast_boolean", "flag", "coalesce(trim(flag), '') <> ''", c.to_boolean)
over_raw("truncate_trim", "txt", "trim(substr(trim(txt), 1, 6))", lambda x: c.fit(x, 6))
BITS = {"Y": 1, "N": 0, "": 0, " ": 0}
over_raw("char_to_bit", "flag", "CASE WHEN upper(trim(flag)) = 'Y' THEN 1 ELSE 0 END", lambda x: c.char_to_bit(x, BITS))
over_raw("boolean_to_bit", "flag", "CASE WHEN lower(trim(flag)) = 'true' THEN 1 ELSE 0 END", lambda x: c.boolean_to_bit(x, {"true": 1, "false": 0}))
over_raw("extract_numeric", "phone", "try_cast(nullif(regexp_replace(phone, '[^0-9]', '', 'g'), '') AS BIGINT)", c.digits_to_number)
over_raw("numbers_only", "phone", "nullif(regexp_replace(phone, '[^0-9]', '', 'g'), '')", c.digits)
over_raw("first_number", "phone", "try_cast(regexp_extract(phone, '([0-9]+(\\.[0-9]+)?)', 1) AS DOUBLE)", c.first_number)
over_raw("default_value", "txt", "coalesce(nullif(trim(txt), ''), 'none given')", lambda x: c.with_default(x, "none given", "string"))
over_raw("normalize_ws", "txt", "trim(regexp_replace(txt, '\\s+', ' ', 'g'))", c.squash_ws)
over_raw("safe_numeric", "num", "coalesce(try_cast(trim(num) AS DOUBLE), -1.0)", lambda x: c.safe_float(x, -1.0))
over_raw("id_normalise", "ssn", "CASE WHEN regexp_matches(trim(ssn), '^[0-9]+$') THEN try_cast(ssn AS BIGINT) END", c.to_id)
over_raw("strip_punct", "phone", "left(rtrim(translate(phone, '-() ', '')), 9)", lambda x: c.strip_punct(x, 9))
over_raw("blank_to_null", "txt", "nullif(trim(txt), '')", c.blank_to_null)
over_raw("isdate_guard", "dt", "CASE WHEN id % 6 IN (0, 1, 4) THEN d ELSE '1900-01-01' END", lambda x: c.date_or(x, "1900-01-01").cast("string"))
over_raw(
    "code_case",
    "pr",
    "CASE WHEN rtrim(pr) IN ('1-URGENT', '2-HIGH') THEN 10 WHEN rtrim(pr) = '3-MEDIUM' THEN 20 ELSE 30 END",
    lambda x: c.code_map(x, [(["1-URGENT", "2-HIGH"], 10), (["3-MEDIUM"], 20)], 30),
)
over_raw("ssn_last4", "ssn", "right(ssn, 4)", lambda x: c.last_n(x, 4))
over_raw("display_strings", "pr", "concat(upper(pr), ' ', lower(pr))", lambda x: c.display_name(x, x))
over_raw("normalise_bit", "flag", "CASE WHEN upper(trim(flag)) IN ('1', 'TRUE', 'YES', 'Y', 'ON') THEN 1 ELSE 0 END", c.normal_bit)
over_raw("meaningful_kv", "txt", "coalesce(lower(trim(txt)) NOT IN ('', 'null', 'none'), FALSE)", c.meaningful)
over_raw("positive_amount", "num", "coalesce(try_cast(trim(num) AS DOUBLE) > 0, FALSE)", c.is_positive)


@query("required_default", "SELECT id, coalesce(nullif(trim(txt), ''), 'REQUIRED') AS out FROM raw")
def required_default(t):
    return quality.require(t.raw.select("id", F.col("txt").alias("out")), "id", "raw", "out", "REQUIRED")[0]


@query(
    "required_reject",
    "SELECT id AS doc_id, 'raw' AS table_name, 'txt' AS field, 'required' AS \"check\", 'critical' AS severity, "
    "'no value and no default' AS message FROM raw WHERE coalesce(trim(txt), '') = ''",
)
def required_reject(t):
    return quality.require(t.raw.select("id", "txt"), "id", "raw", "txt")[1]



CONTRACT = k.Contract(
    "Envelope", "/Envelope/Request/CustData/application", [], [], enums={"status": {"F": 1, "O": 2, "": 9}},
    bits={"char_to_bit": BITS, "boolean_to_bit": {"true": 1, "false": 0}},
)


def mapped(column: Column, **kw) -> Column:
    return k.apply_chain(column, k.Mapping("", "", "t", "out", **kw), CONTRACT)


over_raw(
    "mapping_chain",
    "phone",
    "CASE WHEN nullif(regexp_replace(phone, '[^0-9]', '', 'g'), '') IS NULL THEN 'n/a' ELSE substr(regexp_replace(phone, "
    "'[^0-9]', '', 'g'), 1, 5) END",
    lambda x: mapped(x, mapping_type=["numbers_only"], data_length=5, default_value="n/a"),
)
over_raw(
    "direct_map",
    "phone",
    "CASE WHEN phone IS NULL OR NOT regexp_matches(phone, '[0-9]') THEN -1 ELSE CAST(regexp_extract(phone, '([0-9]+)', 1) "
    "AS INTEGER) END",
    lambda x: mapped(x, data_type="int", default_value=-1),
)
over_raw("unknown_type", "txt", "trim(substr(trim(txt), 1, 8))", lambda x: mapped(x, mapping_type=["identity_insert"], data_length=8))
over_raw(
    "enum_fallback",
    "st",
    "CASE WHEN id % 2 = 0 THEN 5 WHEN st = 'F' THEN 1 WHEN st = 'O' THEN 2 ELSE 9 END",
    lambda x: k.apply_chain(
        x,
        k.Mapping("", "", "t", "out", mapping_type=["calculated_field", "enum"], expression="CASE WHEN id % 2 = 0 THEN 5 END", enum_name="status"),
        CONTRACT,
    ),
)


def shout(column: Column, mapping: k.Mapping, contract: k.Contract) -> Column:
    return F.concat(F.upper(column), F.lit("!"))


k.register("shout", shout)
over_raw("custom_mapping_type", "txt", "CASE WHEN txt IS NOT NULL THEN concat(upper(trim(txt)), '!') END", lambda x: mapped(F.trim(x), mapping_type=["shout"]))


@query(
    "bit_with_default_flag",
    "SELECT id, CASE WHEN upper(trim(flag)) = 'Y' THEN 1 ELSE 0 END AS bit, coalesce(upper(trim(flag)), '') NOT IN ('Y', "
    "'N') AS defaulted FROM raw",
)
def bit_with_default_flag(t):
    return t.raw.select("id", c.char_to_bit_flag(F.col("flag"), BITS).alias("s")).select("id", "s.*")


@query(
    "default_now",
    "SELECT id, CASE id % 6 WHEN 0 THEN concat(d, ' 08:46:18') WHEN 1 THEN concat(d, ' 00:00:00') WHEN 2 THEN concat(d, ' "
    "00:00:00') WHEN 3 THEN concat(d, ' 13:05:09') WHEN 4 THEN concat(d, ' 23:59:59') ELSE '2024-05-06 07:08:09' END AS "
    "out FROM raw",
)
def default_now(t):
    return t.raw.select("id", F.date_format(c.default_now(F.col("dt"), "2024-05-06 07:08:09"), "yyyy-MM-dd HH:mm:ss").alias("out"))


@query(
    "income_basis",
    "SELECT app_id, pos, CASE n % 3 WHEN 0 THEN ((2 * CAST(round(amount * 100) AS BIGINT) + 12) // 24) / 100.0 WHEN 1 THEN "
    "CAST(round(amount * 100) AS BIGINT) / 100.0 ELSE ((2 * 52 * CAST(round(amount * 100) AS BIGINT) + 12) // 24) / 100.0 "
    "END AS monthly FROM contacts",
)
def income_basis(t):
    basis = F.when(F.col("n") % 3 == 0, "ANNUAL").when(F.col("n") % 3 == 1, "MONTH").otherwise("WEEK")
    return t.contacts.select(
        "app_id", "pos",
        c.monthly(F.col("amount").cast("decimal(12,2)"), basis, {"ANNUAL": (1, 12), "MONTH": (1, 1), "WEEK": (52, 12)}).cast("double").alias("monthly"),
    )


@query("months_total", "SELECT app_id, pos, CAST(n + CAST(qty AS INTEGER) * 12 AS SMALLINT) AS months FROM contacts")
def months_total(t):
    return t.contacts.select("app_id", "pos", c.months(F.col("n"), F.col("qty").cast("int")).alias("months"))


@query(
    "date_diff_status",
    "SELECT id, CASE WHEN date_diff('day', CAST(d AS DATE), DATE '1998-08-02') <= 365 THEN 'new' WHEN date_diff('day', "
    "CAST(d AS DATE), DATE '1998-08-02') <= 1500 THEN 'aged' ELSE 'old' END AS band FROM raw",
)
def date_diff_status(t):
    return t.raw.select("id", c.age_band(F.col("d").cast("date"), "1998-08-02", [(365, "new"), (1500, "aged")], "old").alias("band"))


@query("enum_lookup", "SELECT id, CASE st WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 9 END AS code FROM raw")
def enum_lookup(t):
    """Exact, then in any case, then the code of the empty key."""
    return t.raw.select("id", c.enum_code(F.col("st"), {"f": 1, "O": 2, "": 9}).alias("code"))


@query(
    "enum_reference",
    "SELECT enum_id, type, value, CASE WHEN type LIKE 'type_0%' THEN 'home' ELSE 'abroad' END AS category FROM enums WHERE "
    "type IN ('type_0', 'type_1', 'type_3')",
)
def enum_reference(t):
    return t.enums.filter(F.col("type").isin("type_0", "type_1", "type_3")).withColumn("category", F.when(F.col("type").like("type_0%"), "home").otherwise("abroad")).orderBy("type", "enum_id")


@query("decode_bytes", "SELECT doc_id, text AS decoded FROM documents")
def decode_bytes(t):
    """Even documents as UTF-8, odd ones as Windows-1252 where they can be: bytes that are also UTF-8 would be read as that."""
    from ..sources.documents import decode_text, encode_cp1252

    bytes_ = encode_cp1252(F.col("text"))
    single = (F.col("doc_id") % 2 == 1) & ~F.is_valid_utf8(bytes_.cast("string"))
    data = F.when(single, bytes_).otherwise(F.encode("text", "UTF-8"))
    return t.documents.select("doc_id", decode_text(data).alias("decoded"))
