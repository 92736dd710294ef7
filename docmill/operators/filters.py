"""Filters of elements and of mapped rows."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import nonblank


def rule_filter(df: DataFrame, required: dict[str, bool | list[str]], strict: bool = False) -> DataFrame:
    """All rules hold: True asks for a value, a list for one of these (in any case, unless strict)."""

    def holds(name: str, rule: bool | list[str]) -> Column:
        c = F.trim(F.col(name))
        if rule is True:
            return nonblank(c)
        return c.isin(rule) if strict else F.upper(c).isin([str(v).upper() for v in rule])

    tests = [holds(n, r) for n, r in required.items()]
    return df.filter(functools.reduce(operator.and_, tests, F.lit(True)))


def valid_party(df: DataFrame, id: str, type: str, types: list[str]) -> DataFrame:
    return df.filter(nonblank(F.col(id)) & F.trim(F.col(type)).isin(types))


def any_nonblank(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows with a value in one of the columns."""
    return df.filter(functools.reduce(operator.or_, [nonblank(F.col(c)) for c in cols]))


def filled(cols: list[str]) -> Column:
    """How many of the columns have a value."""
    return functools.reduce(operator.add, [F.when(nonblank(F.col(c)), 1).otherwise(0) for c in cols])


def drop_default_only(df: DataFrame, values: dict[str, str | None]) -> DataFrame:
    """Rows with a value that wasn't a default; `values` names each column and, if any, its flag column."""
    real = [nonblank(F.col(c)) & (F.lit(True) if flag is None else ~F.coalesce(F.col(flag), F.lit(False))) for c, flag in values.items()]
    return df.filter(functools.reduce(operator.or_, real))


def blank_conditional(df: DataFrame, meaningful: list[str], conditional: list[str], least: int = 2) -> DataFrame:
    """Conditional defaults become null in rows with fewer than `least` meaningful values."""
    few = filled(meaningful) < least
    return df.withColumns({c: F.when(~few, F.col(c)) for c in conditional})


def defaulted(source: Column, out: Column, default: object) -> Column:
    return ~nonblank(source) & (out == F.lit(default))


def quick_search(df: DataFrame, term: str, ids: list[str], prefixes: list[str], ends: dict[str, int] | None = None, inside: list[str] | None = None) -> DataFrame:
    """Rows that a term matches: an id in full, a prefix in any case, the last characters, or anywhere."""
    t = term.strip()
    tests = [F.col(c).cast("string") == t for c in ids]
    tests += [F.upper(F.col(c)).startswith(t.upper()) for c in prefixes]
    tests += [F.right(F.col(c).cast("string"), F.lit(n)) == t for c, n in (ends or {}).items()]
    tests += [F.upper(F.col(c)).contains(t.upper()) for c in inside or []]
    return df.filter(functools.reduce(operator.or_, tests))
