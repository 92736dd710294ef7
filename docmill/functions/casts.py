"""Casts and scalar mappings. Each is a Column function; text that doesn't fit becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Formats in the order in which they are tried.
DATE_TIMES = [
    "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "M/d/yyyy", "M/d/yyyy H:mm:ss", "M/d/yyyy h:mm:ss a", "d/M/yyyy",
    "d/M/yyyy H:mm:ss",
]
LENIENT = ["yyyy-M-d H:m:s.SSSSSS", "yyyy-M-d H:m:s", "yyyy-M-d", "M/d/yyyy", "M/d/yyyy H:m:s", "M/d/yyyy h:m:s a", "d/M/yyyy", "d/M/yyyy H:m:s"]
WHOLE = {"smallint", "int", "bigint", "tinyint"}


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def nonblank(c: Column) -> Column:
    return F.coalesce(F.trim(c.cast("string")) != "", F.lit(False))


def number(c: Column) -> Column:
    """Trimmed text without thousands separators, as decimal(38,10)."""
    return F.replace(F.trim(c), F.lit(","), F.lit("")).try_cast("decimal(38,10)")


def to_int(c: Column, type: str = "int") -> Column:
    """Rounded half up."""
    return F.round(number(c), 0).try_cast(type)


def to_decimal(c: Column, scale: int = 2) -> Column:
    """Rounded half up; null where 38 digits don't hold it."""
    return F.round(number(c), scale).try_cast(f"decimal(38,{scale})")


def to_double(c: Column) -> Column:
    return F.trim(c).try_cast("double")


def clamp_seconds(c: Column) -> Column:
    """Two-digit seconds beyond 59 become 59, and what follows the fraction is cut."""
    p = r"^(.*\d{1,2}:\d{1,2}:)(\d{2})(\.\d+)?"
    head, seconds, fraction = (F.regexp_extract(c, p, k) for k in (1, 2, 3))
    return F.when((seconds != "") & (seconds.try_cast("int") > 59), F.concat(head, F.lit("59"), fraction)).otherwise(c)


def to_datetime(c: Column, formats: list[str] | None = None) -> Column:
    """The first format that fits; then ISO with a zone."""
    t = clamp_seconds(F.trim(c))
    tries = [F.try_to_timestamp(t, F.lit(f)) for f in formats or LENIENT]
    return F.coalesce(*tries, t.try_cast("timestamp")).cast("timestamp_ntz")


def to_bit(c: Column) -> Column:
    """Truth of the raw text: any text but a blank one is 1, '0' too. Contracts should map characters instead."""
    return F.when(nonblank(c), 1).otherwise(0)


def to_boolean(c: Column) -> Column:
    return nonblank(c)


def fit(c: Column, n: int) -> Column:
    """Trimmed, cut to n characters, trimmed again."""
    return F.trim(F.substring(F.trim(c), 1, n))


def lookup(c: Column, table: dict[str, object], default: object = None, fold: str = "exact") -> Column:
    """A literal map: exact first, then folded ('upper' or 'lower'); a default for the rest."""
    t = F.trim(c)
    tries = [t] if fold == "exact" else [t, getattr(F, fold)(t)]
    literal = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    found = [F.try_element_at(literal, F.coalesce(k, F.lit(""))) for k in tries]
    return F.coalesce(*found, F.lit(default))


def char_to_bit(c: Column, table: dict[str, int]) -> Column:
    return lookup(c, table, 0, "upper").cast("int")


def boolean_to_bit(c: Column, table: dict[str, int]) -> Column:
    return lookup(F.lower(c), table, 0).cast("int")


def char_to_bit_flag(c: Column, table: dict[str, int]) -> Column:
    """The bit, and whether it came from the default."""
    known = F.upper(F.trim(F.coalesce(c, F.lit("")))).isin([k.upper() for k in table if k])
    return F.struct(char_to_bit(c, table).alias("bit"), (~known).alias("defaulted"))


def enum_code(c: Column, codes: dict[str, int], default: int | None = None) -> Column:
    """Text to a code: exact, then in any case, then the code of '', then the default. Without codes all is unknown."""
    if not codes:
        return F.lit(default).cast("int")
    folded = {k.lower(): v for k, v in codes.items()}
    exact = F.create_map(*[F.lit(x) for kv in codes.items() for x in kv])
    any_case = F.create_map(*[F.lit(x) for kv in folded.items() for x in kv])
    t = F.coalesce(F.trim(c), F.lit(""))
    return F.coalesce(F.try_element_at(exact, t), F.try_element_at(any_case, F.lower(t)), F.lit(codes.get("")).cast("int"), F.lit(default).cast("int"))


def digits(c: Column) -> Column:
    return F.nullif(F.regexp_replace(c, "[^0-9]", ""), F.lit(""))


def digits_to_number(c: Column, type: str = "bigint") -> Column:
    return digits(c).try_cast(type)


def first_number(c: Column) -> Column:
    return F.regexp_extract(c, r"(\d+(\.\d+)?)", 1).try_cast("double")


def default_now(c: Column, run_ts: str) -> Column:
    """A blank becomes the run's time, which is a parameter so that results repeat."""
    return F.coalesce(to_datetime(blank_to_null(c)), F.lit(run_ts).cast("timestamp_ntz"))


def with_default(c: Column, value: object, type: str, length: int | None = None) -> Column:
    return cast_to(F.coalesce(blank_to_null(c), F.lit(str(value))), type, length)


def squash_ws(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def safe_int(c: Column, default: int | None = None) -> Column:
    """The whole part, exact for all numbers of 64 bits in plain digits; others, such as those with an exponent, go through a double."""
    t = F.trim(c)
    plain = F.regexp_extract(t, r"^([+-]?\d+)(?:\.\d*)?$", 1).try_cast("bigint")
    return F.coalesce(plain, t.try_cast("double").try_cast("bigint"), F.lit(default).cast("bigint"))


def safe_float(c: Column, default: float | None = None) -> Column:
    return F.coalesce(F.trim(c).try_cast("double"), F.lit(default).cast("double"))


def to_id(c: Column) -> Column:
    """All-digit ids as numbers; the rest is null, and a finding."""
    return F.when(F.trim(c).rlike("^[0-9]+$"), F.trim(c).try_cast("bigint"))


def strip_punct(c: Column, n: int) -> Column:
    return F.left(F.rtrim(F.translate(c, "-() ", "")), F.lit(n))


def date_or(c: Column, default: str | None = None) -> Column:
    return F.coalesce(F.trim(c).try_cast("date"), F.lit(default).cast("date"))


def code_map(c: Column, pairs: list[tuple[list[str], int]], else_: int | None = None) -> Column:
    out = F.lit(else_).cast("int")
    for codes, value in reversed(pairs):
        out = F.when(F.rtrim(c).isin(codes), value).otherwise(out)
    return out


def monthly(amount: Column, basis: Column, factors: dict[str, tuple[int, int]]) -> Column:
    """An amount by its basis as a monthly one: times the first number of a factor, over the second."""
    out = F.lit(None).cast("decimal(38,10)")
    for name, (times, over) in factors.items():
        out = F.when(F.upper(F.trim(basis)) == name, F.try_divide(F.try_multiply(amount, F.lit(times)), F.lit(over))).otherwise(out)
    return F.round(out, 2)


def months(m: Column, y: Column) -> Column:
    """Months and years in months; null where that is beyond a smallint."""
    return (F.coalesce(m.cast("decimal(20,0)"), F.lit(0)) + F.coalesce(y.cast("decimal(20,0)"), F.lit(0)) * 12).try_cast("smallint")


def last_n(c: Column, n: int) -> Column:
    return F.right(c, F.lit(n))


def display_name(first: Column, last: Column) -> Column:
    return F.concat_ws(" ", F.upper(first), F.lower(last))


def age_band(day: Column, now: str, cuts: list[tuple[int, str]], beyond: str) -> Column:
    age = F.datediff(F.lit(now).cast("date"), day)
    out = F.lit(beyond)
    for limit, name in reversed(cuts):
        out = F.when(age <= limit, name).otherwise(out)
    return out


def normal_bit(c: Column) -> Column:
    return F.when(F.upper(F.trim(c.cast("string"))).isin("1", "TRUE", "YES", "Y", "ON"), 1).otherwise(0)


def meaningful(c: Column) -> Column:
    """Neither blank nor the words null or none."""
    return F.coalesce(~F.lower(F.trim(c)).isin("", "null", "none"), F.lit(False))


def is_positive(c: Column) -> Column:
    return F.coalesce(F.trim(c).try_cast("double") > 0, F.lit(False))


def cast_to(c: Column, type: str, length: int | None = None) -> Column:
    """A contract's data type. length is characters of a string, or the scale of a decimal; unknown types are strings."""
    if type in WHOLE:
        return to_int(c, type)
    if type == "integer":
        return to_int(c, "int")
    if type == "decimal":
        return to_decimal(c, 2 if length is None else length)
    if type == "float":
        return to_double(c)
    if type in ("datetime", "smalldatetime", "date"):
        return to_datetime(c)
    if type == "bit":
        return to_bit(c)
    if type == "boolean":
        return to_boolean(c)
    return F.trim(c) if length is None else fit(c, length)
