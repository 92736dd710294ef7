"""Casts, mappings and calculated columns on single values."""

import datetime

import pytest
from pyspark.sql import functions as F

from docmill.functions import calculated
from docmill.functions import casts as c
from docmill.plans import contract as k


def values(spark, build, given):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(given)], "i int, v string")
    return [r.out for r in rows.select("i", build(F.col("v")).alias("out")).orderBy("i").collect()]


@pytest.mark.parametrize(("build", "given", "want"), [
    (c.to_int, ["2.5", "-2.5", " 1,234 ", "", "x", None, "9999999999"], [3, -3, 1234, None, None, None, None]),
    (lambda v: c.to_decimal(v).cast("string"), ["1.005", "-1.005", "12", "bad"], ["1.01", "-1.01", "12.00", None]),
    (c.to_bit, ["0", "", " ", None, "Y"], [1, 0, 0, 0, 1]),
    (lambda v: c.fit(v, 4), ["  ab cdef ", "abc   d"], ["ab c", "abc"]),
    (c.digits, ["a1b2", "none", ""], ["12", None, None]),
    (c.first_number, ["up to 12.5%", "x", "7 or 8"], [12.5, None, 7.0]),
    (lambda v: c.enum_code(v, {"Y": 1, "n": 2, "": 9}), ["Y", "y", "N", "", "zz", None], [1, 1, 2, 9, 9, 9]),
    (lambda v: c.char_to_bit(v, {"Y": 1, "N": 0}), ["y", "Y", "N", "", None, "Q"], [1, 1, 0, 0, 0, 0]),
    (c.meaningful, ["x", " ", "NULL", "None", None], [True, False, False, False, False]),
    (c.to_id, ["12", "a1", " 7 ", "-3", None], [12, None, 7, None, None]),
    (lambda v: c.strip_punct(v, 10), ["(555) 123-4567 "], ["5551234567"]),
    (c.normal_bit, ["yes", "on", "0", None], [1, 1, 0, 0]),
    (c.squash_ws, [" a \n\t b "], ["a b"]),
])
def test_cast(spark, build, given, want):
    assert values(spark, build, given) == want


@pytest.mark.parametrize(("text", "want"), [
    ("2023-11-21 8:46:18.55", datetime.datetime(2023, 11, 21, 8, 46, 18, 550000)), ("2023-11-21 10:05:88", datetime.datetime(2023, 11, 21, 10, 5, 59)), ("11/21/2023", datetime.datetime(2023, 11, 21)),
    ("21/11/2023", datetime.datetime(2023, 11, 21)), ("11/21/2023 1:05:00 PM", datetime.datetime(2023, 11, 21, 13, 5)), ("2023-11-21T10:00:00Z", datetime.datetime(2023, 11, 21, 10)), ("junk", None), ("", None),
])
def test_datetime(spark, text, want):
    assert values(spark, c.to_datetime, [text]) == [want]


@pytest.mark.parametrize(("expression", "want"), [
    ("a + b * 2", "13.0"), ("(a + b) * 2", "16.0"), ("2 ** 3 - 1", "7.0"), ("-a + 1", "-2.0"), ("a / 0", None), ("a + blank", None), ("7 // 2", "3.0"), ("7 % 4", "3.0"),
    ("CASE WHEN a = 3 AND b > 4 THEN 'x' ELSE 'y' END", "x"), ("CASE WHEN a = 9 OR NOT b = 5 THEN 'x' END", None), ("CASE WHEN name LIKE 'j%n' THEN 'j' END", "j"), ("CASE WHEN name LIKE 'a.c' THEN 'j' END", None),
    ("CASE WHEN blank IS EMPTY THEN 1 ELSE 2 END", "1"), ("CASE WHEN blank IS NOT NULL THEN 'set' END", "set"), ("CASE WHEN (a = 1 OR b = 5) AND name != 'x' THEN 'ok' END", "ok"), ("DATEADD(day, a, '2024-02-27')", "2024-03-01"),
    ("CASE WHEN DATE('2024-01-01') < DATE('1/2/2024') THEN 'before' END", "before"), ("CASE WHEN a >= '3' THEN 'it''s' END", "it's"), ("CASE WHEN a > 2 THEN CASE WHEN b > 9 THEN 'p' ELSE 'q' END END", "q"),
])
def test_calculated(spark, expression, want):
    row = spark.sql("SELECT '3' AS a, '5' AS b, '  ' AS blank, 'John' AS name")
    assert row.select(calculated.calc(expression, lambda n: F.col(n)).cast("string").alias("v")).first().v == want


@pytest.mark.parametrize("expression", ["a +", "CASE WHEN a THEN 1", "a b", "a ? b"])
def test_calculated_refuses(spark, expression):
    with pytest.raises((ValueError, IndexError)):
        calculated.calc(expression, lambda n: F.col(n))


def test_contract_from_json(spark):
    text = """{"xml_root_element": "R", "xml_application_path": "/R/a", "repeated_paths": ["/R/a/c"], "enum_mappings": {"e": {"X": 1}},
      "mappings": [{"xml_path": "/R/a", "xml_attribute": "n", "target_table": "t", "target_column": "n", "data_type": "int", "mapping_type": "numbers_only, unknown", "other": 1},
                   {"xml_path": "/R/a/c", "xml_attribute": "k", "target_table": "t2", "target_column": "k", "nullable": false}]}"""
    got = k.Contract.load(text)
    assert got.mappings[0].mapping_type == ["numbers_only", "unknown"]
    assert got.schema().simpleString() == "struct<a:struct<_n:string,c:array<struct<_k:string>>>>"
    rows = k.parse(spark.createDataFrame([(1, '<R><a n="no 12"><c k="1"/></a></R>'), (2, "<R><a"), (3, None)], "doc_id long, xml string"), got)
    assert [r.n for r in k.table(rows, got, "t", {"/R/a": "d.a"}, ["doc_id"]).collect()] == [12]


def test_required_findings(spark):
    m = k.Mapping("/R", "a", "t", "a", nullable=False)
    rows = spark.createDataFrame([(1, "x"), (2, None)], "doc_id long, a string")
    assert [r.doc_id for r in k.required_findings(rows, k.Contract("R", "/R", [], [m]), "t", "doc_id").collect()] == [2]


#: Values at which casts and arithmetic overflow, and text that is none of what it should be.
ODD = [
    None, "", " ", "abc", "9" * 40, "-" + "9" * 40, "9" * 28, "1e308", "-1e308", "1e400", "1e-400", "NaN", "Infinity", "-0", "0", "1", "2", "-1", "0.5", "0x10", "1,234.5", "1.5.2", "12/31/9999", "0000-00-00",
    "9999-12-31", "9999-12-31 23:59:99", "2024-02-30", "1/1/0001", "9223372036854775807", "9223372036854775808", "9007199254740993", "99999999999", "4000000", "-3999999", "32767", "ünï", "'; --", "\x00", "%", "Y", "2024-01-15",
]
CODES = {"A": 1, "": 9}
ONE = {
    "blank_to_null": c.blank_to_null, "nonblank": c.nonblank, "number": c.number, "to_double": c.to_double, "clamp_seconds": c.clamp_seconds, "to_datetime": c.to_datetime,
    "to_bit": c.to_bit, "to_boolean": c.to_boolean, "fit": lambda v: c.fit(v, 3), "lookup": lambda v: c.lookup(v, CODES, 5, "upper"), "char_to_bit": lambda v: c.char_to_bit(v, {"Y": 1}),
    "boolean_to_bit": lambda v: c.boolean_to_bit(v, {"true": 1}), "char_to_bit_flag": lambda v: c.char_to_bit_flag(v, {"Y": 1}), "enum_code": lambda v: c.enum_code(v, CODES), "no_codes": lambda v: c.enum_code(v, {}, 3),
    "digits": c.digits, "digits_to_number": c.digits_to_number, "first_number": c.first_number, "default_now": lambda v: c.default_now(v, "2024-01-01 00:00:00"),
    "squash_ws": c.squash_ws, "safe_int": c.safe_int, "safe_float": c.safe_float, "to_id": c.to_id, "strip_punct": lambda v: c.strip_punct(v, 4), "date_or": lambda v: c.date_or(v, "2024-01-01"),
    "code_map": lambda v: c.code_map(v, [(["1"], 7)]), "last_n": lambda v: c.last_n(v, 4), "normal_bit": c.normal_bit, "meaningful": c.meaningful, "is_positive": c.is_positive,
    "monthly": lambda v: c.monthly(c.number(v), F.lit("ANNUM"), {"ANNUM": (52, 12)}), "months": lambda v: c.months(c.safe_int(v), c.safe_int(v)), "display_name": lambda v: c.display_name(v, v),
    "age_band": lambda v: c.age_band(c.date_or(v), "2024-01-01", [(30, "new")], "old"), "date_of": calculated.date_of,
    **{f"to_int {t}": (lambda v, t=t: c.to_int(v, t)) for t in sorted(c.WHOLE)}, **{f"to_decimal {n}": (lambda v, n=n: c.to_decimal(v, n)) for n in (0, 2, 10, 20)},
    **{f"cast_to {t}": (lambda v, t=t: c.cast_to(v, t)) for t in (*sorted(c.WHOLE), "integer", "decimal", "float", "datetime", "date", "bit", "boolean", "string", "strange")},
    **{f"with_default {t}": (lambda v, t=t: c.with_default(v, "1", t)) for t in ("int", "decimal", "datetime")},
}


@pytest.mark.parametrize("name", sorted(ONE))
def test_no_value_ends_the_job(spark, name):
    """Whatever the text, a function gives a value or null: all values in one job."""
    rows = spark.createDataFrame([(v,) for v in ODD], "a string")
    assert len(rows.select(ONE[name](F.col("a")).cast("string").alias("v")).collect()) == len(ODD)


@pytest.mark.parametrize("text", [
    "a + b", "a - b", "a * b", "a / b", "a // b", "a % b", "a ** b", "-a ** -b", "a * a * a * b", "DATEADD(day, a, b)", "DATEADD(day, a * 1000000000, DATE(b))",
    "CASE WHEN a < b THEN a WHEN a LIKE b THEN 1 WHEN DATE(a) >= b THEN a % 0 WHEN a IS EMPTY OR b IS NOT NULL THEN DATEADD(day, b, a) ELSE a // b END",
])
def test_no_expression_ends_the_job(spark, text):
    if "LIKE b" in text:
        text = text.replace("LIKE b", "LIKE '%1%'")
    rows = spark.createDataFrame([(a, b) for a in ODD for b in ODD], "a string, b string")
    assert len(rows.select(calculated.calc(text, F.col).cast("string").alias("v")).collect()) == len(ODD) ** 2


def test_large_numbers_stay_right(spark):
    row = spark.createDataFrame([("1e20", "7", "9007199254740993", "-7", "12.7", "-12.9")], "a string, b string, c string, d string, e string, f string")
    calc = lambda text: calculated.calc(text, F.col)
    got = row.select(
        calc("a // 1").alias("floor"), calc("a % b").alias("mod"), calc("d % 3").alias("negative"), calc("b % d").alias("below"), c.safe_int(F.col("c")).alias("whole"), c.safe_int(F.col("f")).alias("cut"),
        c.cast_to(F.col("e"), "decimal", 0).cast("string").alias("scale"), calc("DATEADD(day, 9999999999, '2024-01-01')").alias("far"), calc("DATEADD(day, -1, '2024-01-01')").alias("near"),
    ).first()
    assert tuple(got) == (1e20, float(10**20 % 7), 2.0, -0.0, 9007199254740993, -12, "13", None, "2023-12-31")
