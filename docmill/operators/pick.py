"""Pick one of several rows or elements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.casts import nonblank


def last_of_type(contacts: DataFrame, doc: str, type_col: str, type: str, value: str, pos: str, valid: str | None = None) -> DataFrame:
    """The value in each document's last contact of a type; with `valid`, contacts without that id don't count."""
    some = contacts.filter(F.trim(F.col(type_col)) == type)
    some = some.filter(nonblank(F.col(valid))) if valid else some
    return some.groupBy(doc).agg(F.max_by(F.struct(F.col(value).alias("v")), pos)["v"].alias(value))


def last_nonblank(contacts: DataFrame, doc: str, value: str, pos: str) -> DataFrame:
    """The latest value that isn't blank."""
    return contacts.filter(nonblank(F.col(value))).groupBy(doc).agg(F.max_by(value, pos).alias(value))


def preferred_child(children: Column, type_field: str, type: str) -> Column:
    """The last child of the preferred type, of an array."""
    return F.try_element_at(F.filter(children, lambda x: F.trim(x[type_field]) == type), F.lit(-1))


def nth(df: DataFrame, keys: list[str], *order: str | Column) -> DataFrame:
    """The first row of each key in an order that must be total."""
    return df.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_nth = 1").drop("_nth")


def dedupe_priority(df: DataFrame, keys: list[str], type_col: str, order: list[str], *pos: str) -> DataFrame:
    """The row of the best type (by the list; unknown ones last); of equals, the last."""
    rank = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, order)), F.col(type_col)), F.lit(0)), F.lit(999))
    return nth(df, keys, rank.asc(), *[F.desc(p) for p in pos])


def keep_last(df: DataFrame, keys: list[str], *pos: str) -> DataFrame:
    return nth(df, keys, *[F.desc(p) for p in pos])


def keep_first(df: DataFrame, keys: list[str], *pos: str) -> DataFrame:
    return nth(df, keys, *[F.asc(p) for p in pos])


def latest(df: DataFrame, by: str, order: str, value: str) -> DataFrame:
    """The newest value for each key: one aggregation, no sort."""
    return df.groupBy(by).agg(F.max_by(value, order).alias(value))


def max_per(df: DataFrame, by: str, id: str) -> DataFrame:
    return df.groupBy(by).agg(F.max(id).alias(id))


def settle(df: DataFrame, keys: list[str], *order: str | Column) -> DataFrame:
    """One row of each key (null is a key): the first in an order, or without one the least by its columns, so the choice repeats. One aggregation."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    row = F.struct(*rest)
    first = F.min_by(row, F.struct(*order, row.alias("_row"))) if order else F.min(row)
    return df.groupBy(*keys).agg(first.alias("_first")).select(*[c if c in keys else F.col(f"_first.`{c}`") for c in df.columns])
