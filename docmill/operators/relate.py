"""Joins between documents' tables. Hints are left to Spark: its size statistics and adaptive plans decide on broadcasts."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def wide_row(base: DataFrame, ones: list[DataFrame], contacts: DataFrame, children: list[tuple[DataFrame, Column]], key: str, contact_key: str) -> DataFrame:
    """A row per application and contact: 1:1 children by left joins, and of each contact child the current one.

    The condition on a child is part of its join, so that contacts without one stay.
    """
    out = base
    for one in ones:
        out = out.join(one, key, "left")
    out = out.join(contacts, key)
    for child, current in children:
        out = out.join(child.filter(current), contact_key, "left")
    return out


#: Codes that are decoded by one broadcast row; longer lists are joined.
CODES = 100_000


def decode_enums(df: DataFrame, enums: DataFrame, cols: dict[str, str], most: int = CODES) -> DataFrame:
    """Add the value of each code column (column to new name); of several values with one code the smallest.

    A list of at most `most` codes is one broadcast row that holds it as a map, so any number of columns is decoded by
    expressions in one pass; a longer one is joined, once for each column.
    """
    names = enums.filter("enum_id is not null").groupBy("enum_id").agg(F.min("value").alias("value"))
    if names.limit(most + 1).count() > most:
        for col, name in cols.items():
            df = df.join(names.select(F.col("enum_id").alias(col), F.col("value").alias(name)), col, "left")
        return df
    kind = dict(names.dtypes)["enum_id"]
    codes = names.agg(F.map_from_entries(F.collect_list(F.struct("enum_id", "value"))).alias("_codes"))
    wide = df.crossJoin(F.broadcast(codes))  # one row
    return wide.withColumns({name: F.try_element_at("_codes", F.col(col).cast(kind)) for col, name in cols.items()}).drop("_codes")


def audit_defaults(df: DataFrame, log: DataFrame, markers: dict[str, object], key: str) -> DataFrame:
    """Rows in which a column has its known default, with the status of their document, if it is logged."""
    marked = df.filter(functools.reduce(operator.or_, [F.col(c) == F.lit(v) for c, v in markers.items()]))
    return marked.join(log.select(key, "status"), key, "left")


def audit_join(base: DataFrame, tables: dict[str, tuple[DataFrame, list[str], dict[str, object]]], key: str) -> DataFrame:
    """Documents with a known default in any of several tables: base left joined to all of them, a row for each combination of their rows.

    tables: name to (table, columns to show, markers). Shown columns are named name_column, and `defaults` lists those that
    have their marker. Only documents with a marker somewhere are joined, so the join is as large as what it finds.
    """
    def has(markers: dict[str, object]) -> Column:
        return functools.reduce(operator.or_, [F.col(c).cast("string") == str(v) for c, v in markers.items()])

    hits = functools.reduce(DataFrame.unionByName, [df.filter(has(markers)).select(key) for df, _, markers in tables.values() if markers]).distinct()
    out, tests = base.join(hits, key, "left_semi"), []
    for name, (df, cols, markers) in tables.items():
        shown = list(dict.fromkeys([*cols, *markers]))
        out = out.join(df.select(key, *[F.col(c).alias(f"{name}_{c}") for c in shown]), key, "left")
        tests += [F.when(F.col(f"{name}_{c}").cast("string") == str(v), f"{name}_{c}") for c, v in markers.items()]
    return out.withColumn("defaults", F.array_join(F.array_compact(F.array(*tests)), ",")).filter("defaults <> ''")


#: A key with more than this share of all rows is hot; there can be no more than 1 / HOT of them, so they may be broadcast.
HOT = 0.002


def semi_hot(df: DataFrame, keys: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """Rows of df whose key is in keys, which has a row for each and, in `count`, about how many rows of df it has.

    Rows of a hot key stay where they are; the others are joined by a shuffle.
    """
    hot = F.broadcast(keys.filter(F.col(count) > HOT * total).select(key))
    few = df.join(hot, key, "left_semi")
    rest = df.join(hot, key, "left_anti").join(keys.filter(F.col(count) <= HOT * total).select(key), key, "left_semi")
    return few.unionByName(rest)


def with_parent(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return child.join(parent.select(key), key, "left_semi")


def where_exists(df: DataFrame, other: DataFrame, key: str, negate: bool = False) -> DataFrame:
    return df.join(other.select(key), key, "left_anti" if negate else "left_semi")


def flag_exists(df: DataFrame, other: DataFrame, key: str, name: str) -> DataFrame:
    """A boolean: does the other table have the key? One row per key on the right, so no row is repeated."""
    return df.join(other.select(key).distinct().withColumn(name, F.lit(True)), key, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def left_top1(df: DataFrame, other: DataFrame, key: str, value: list[str], *order: Column) -> DataFrame:
    """The other table's first row of each key, or nulls."""
    top = other.withColumn("_nth", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter("_nth = 1")
    return df.join(top.select(key, *value), key, "left")


def update_from(df: DataFrame, source: DataFrame, key: str, column: str) -> DataFrame:
    """The column from the source where it has a value for the key, else as it was. The source has a row per key."""
    new = source.select(key, F.col(column).alias("_new"))
    return df.join(new, key, "left").withColumn(column, F.coalesce("_new", column)).drop("_new")


def only_known(df: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    return df.join(reference.select(key), key)


def missing_codes(enums: DataFrame, required: list[int]) -> DataFrame:
    rows = enums.sparkSession.createDataFrame([(c,) for c in required], "enum_id int")
    return rows.join(enums.select(F.col("enum_id").cast("int")), "enum_id", "left_anti")
