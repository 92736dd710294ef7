"""Calculated columns: a contract's expression text becomes one Catalyst Column on the driver, and runs in codegen."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import casts

TOKEN = re.compile(r"\s*(?:(\d+(?:\.\d+)?)|'((?:[^']|'')*)'|([A-Za-z_][\w.]*)|(\*\*|//|!=|<>|<=|>=|[-+*/%()=<>,]))")
DATES = ["yyyy-M-d H:m:s.SSSSSS", "yyyy-M-d H:m:s", "yyyy-M-d", "M/d/yyyy", "M/d/yyyy H:m:s"]
WORDS = {"case", "when", "then", "else", "end", "and", "or", "not", "like", "is", "empty", "null", "date", "dateadd", "day"}


def calc(text: str, field: Callable[[str], Column]) -> Column:
    """The Column of an expression; `field` resolves names, bare or qualified, to text columns.

    Arithmetic is null where a field in it is missing or blank, on errors and on division by zero. Conditions follow
    SQL precedence; a WHEN that can't be judged doesn't hold; without an ELSE the rest is null.
    """
    reader = _Reader(text, field)
    out = reader.case() if reader.peek("case") else reader.sum()
    if reader.at < len(reader.tokens):
        raise ValueError(f"unexpected {reader.tokens[reader.at][1]!r} in {text!r}")
    return out


def date_of(c: Column) -> Column:
    return F.coalesce(*[F.try_to_timestamp(F.trim(c), F.lit(f)) for f in DATES])


def dateadd_day(n: Column, day: Column) -> Column:
    """A date some days on, as text; blank days count as none. Null where the date would leave the years 1 to 9999."""
    days = n.cast("string").try_cast("double")
    start, span = date_of(day).cast("date"), F.coalesce(F.when(F.abs(days) < 4e6, days).cast("int"), F.when(days.isNull(), 0))
    out = F.date_add(start, span)
    return F.when((out >= F.lit("0001-01-01").cast("date")) & (out <= F.lit("9999-12-31").cast("date")), F.date_format(out, "yyyy-MM-dd"))


def whole(c: Column) -> Column:
    """The largest whole number that isn't above a double, as a double: from 2^53 on each double is whole."""
    return F.when(F.abs(c) < float(1 << 53), F.floor(c).cast("double")).otherwise(c)


def modulo(a: Column, b: Column) -> Column:
    """What is left of a after whole b, with the sign of b; exact at any size."""
    left = F.try_mod(a, b)
    return F.when((left != 0) & ((left < 0) != (b < 0)), left + b).otherwise(left)


def is_empty(c: Column) -> Column:
    return F.trim(F.coalesce(c.cast("string"), F.lit(""))) == ""


def is_null(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("")) == ""


def compare(a: Column, op: str, b: Column) -> Column:
    """Dates as dates; two numbers as numbers; text and a number as numbers, with 0 for what is none; else as text."""
    x, y = a.cast("string"), b.cast("string")
    nx, ny = x.try_cast("double"), y.try_cast("double")
    dx, dy = date_of(x), date_of(y)
    tests: dict[str, Callable[[Column, Column], Column]] = {"=": lambda p, q: p == q, "!=": lambda p, q: p != q, "<": lambda p, q: p < q, ">": lambda p, q: p > q, "<=": lambda p, q: p <= q, ">=": lambda p, q: p >= q}
    test = tests["!=" if op == "<>" else op]
    by_number = test(F.coalesce(nx, F.lit(0.0)), F.coalesce(ny, F.lit(0.0)))
    got = F.when(dx.isNotNull() & dy.isNotNull(), test(dx, dy)).when(nx.isNotNull() | ny.isNotNull(), by_number).otherwise(test(x, y))
    return F.when(is_null(x) | is_null(y), F.lit(False)).otherwise(F.coalesce(got, F.lit(False)))


def like(c: Column, pattern: str) -> Column:
    return F.coalesce(F.trim(c).ilike(pattern), F.lit(False))


class _Reader:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, text: str, field: Callable[[str], Column]) -> None:
        self.field, self.at, self.tokens, place = field, 0, [], 0
        text = text.rstrip()
        while place < len(text):
            m = TOKEN.match(text, place)
            if not m:
                raise ValueError(f"can't read {text[place:]!r}")
            kind = next(k for k in (1, 2, 3, 4) if m[k] is not None)
            self.tokens.append((kind, m[kind]))
            place = m.end()

    def peek(self, *words: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] in (3, 4) and self.tokens[self.at][1].lower() in words

    def take(self, *words: str) -> str:
        if not self.peek(*words):
            raise ValueError(f"expected {' or '.join(words)} at token {self.at}")
        self.at += 1
        return self.tokens[self.at - 1][1].lower()

    def case(self) -> Column:
        self.take("case")
        out = None
        while self.peek("when"):
            self.take("when")
            test = self.any_of()
            self.take("then")
            value = self.value()
            out = F.when(test, value) if out is None else out.when(test, value)
        if self.peek("else"):
            self.take("else")
            out = out.otherwise(self.value())
        self.take("end")
        return out

    def value(self) -> Column:
        """What a CASE gives: always text, so that branches agree."""
        if self.peek("case"):
            return self.case()
        kind, text = self.tokens[self.at]
        if kind == 1 and (self.at + 1 == len(self.tokens) or self.tokens[self.at + 1][1].lower() in ("when", "else", "end")):
            self.at += 1
            return F.lit(text)
        return self.sum().cast("string")

    def any_of(self) -> Column:
        out = self.all_of()
        while self.peek("or"):
            self.take("or")
            out = out | self.all_of()
        return out

    def all_of(self) -> Column:
        out = self.test()
        while self.peek("and"):
            self.take("and")
            out = out & self.test()
        return out

    def test(self) -> Column:
        if self.peek("not"):
            self.take("not")
            return ~self.test()
        if self.peek("("):
            mark = self.at
            try:
                self.take("(")
                inner = self.any_of()
                self.take(")")
                return inner
            except ValueError:
                self.at = mark
        left = self.operand()
        if self.peek("is"):
            self.take("is")
            no = self.peek("not") and bool(self.take("not"))
            found = is_empty(left) if self.take("empty", "null") == "empty" else is_null(left)
            return ~found if no else found
        no = self.peek("not") and bool(self.take("not"))
        if self.peek("like"):
            self.take("like")
            kind, text = self.tokens[self.at]
            self.at += 1
            return ~like(left, text) if no else like(left, text)
        return compare(left, self.take("=", "!=", "<>", "<=", ">=", "<", ">"), self.operand())

    def operand(self) -> Column:
        """A side of a comparison: one field or literal as it is, else arithmetic."""
        kind, text = self.tokens[self.at]
        ends = self.at + 1 == len(self.tokens) or self.tokens[self.at + 1][0] == 3 or self.tokens[self.at + 1][1] in ("=", "!=", "<>", "<=", ">=", "<", ">", ")")
        if kind == 2 or (ends and kind == 1) or (ends and kind == 3 and text.lower() not in WORDS):
            self.at += 1
            return F.lit(text.replace("''", "'")) if kind != 3 else self.field(text)
        return self.sum()

    def sum(self) -> Column:
        out = self.product()
        while self.peek("+", "-"):
            out = out + self.product() if self.take("+", "-") == "+" else out - self.product()
        return out

    def product(self) -> Column:
        out = self.power()
        while self.peek("*", "/", "//", "%"):
            op, right = self.take("*", "/", "//", "%"), None
            right = self.power()
            safe = F.when(right != 0, right)
            out = out * right if op == "*" else out / safe if op == "/" else whole(out / safe) if op == "//" else modulo(out, safe)
        return out

    def power(self) -> Column:
        if self.peek("-"):
            self.take("-")
            return -self.power()
        base = self.atom()
        if self.peek("**"):
            self.take("**")
            return F.pow(base, self.power())
        return base

    def atom(self) -> Column:
        if self.peek("("):
            self.take("(")
            out = self.sum()
            self.take(")")
            return out
        kind, text = self.tokens[self.at]
        self.at += 1
        if kind == 1:
            return F.lit(float(text))
        if kind == 2:
            return F.lit(text.replace("''", "'"))
        if kind == 3 and text.lower() == "date":
            self.take("(")
            inner = self.operand()
            self.take(")")
            return date_of(inner)
        if kind == 3 and text.lower() == "dateadd":
            self.take("(")
            self.take("day")
            self.take(",")
            n = self.operand()
            self.take(",")
            day = self.operand() if not self.peek("date") else self.atom().cast("string")
            self.take(")")
            return dateadd_day(n, day)
        if kind == 3 and text.lower() not in WORDS:
            return casts.number(self.field(text)).cast("double")
        raise ValueError(f"unexpected {text!r}")
