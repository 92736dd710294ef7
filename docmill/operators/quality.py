"""Validation as whole-table jobs. All checks give findings (doc_id, table_name, field, check, severity, message)."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FINDING = ["doc_id", "table_name", "field", "check", "severity", "message"]


def finding(df: DataFrame, test: Column, id: str, table: str, field: str, check: str, severity: str, message: str) -> DataFrame:
    return df.filter(test).select(
        F.col(id).alias("doc_id"), *[F.lit(v).alias(n) for n, v in zip(FINDING[1:], (table, field, check, severity, message), strict=True)],
    )


def findings(df: DataFrame, id: str, table: str, checks: list[tuple[str, str, str, str, Column]]) -> DataFrame:
    """One pass for many checks (field, check, severity, message, test): a row for each test that holds."""
    items = F.array(*[F.when(
        F.coalesce(test, F.lit(False)),
        F.struct(F.lit(table).alias("table_name"), F.lit(f).alias("field"), F.lit(c).alias("check"), F.lit(s).alias("severity"), F.lit(m).alias("message")),
    ) for f, c, s, m, test in checks])
    return df.select(F.col(id).alias("doc_id"), F.explode(F.array_compact(items)).alias("_f")).select("doc_id", "_f.*")


def pre_validate(docs: DataFrame, id_text: Column, right: Column, wrong: Column, status: Column) -> DataFrame:
    """errors and warnings of each document: structure, a positive whole id, the right product element."""
    t = F.trim(id_text)
    errors = F.array_compact(F.array(
        F.when(status != "ok", F.concat(F.lit("structure:"), status)),
        F.when(F.coalesce(t, F.lit("")) == "", F.lit("id:missing")),
        F.when((t != "") & ~F.coalesce(t.try_cast("bigint") > 0, F.lit(False)), F.lit("id:not positive")),
        F.when(~right, F.lit("product:missing")),
    ))
    warnings = F.array_compact(F.array(F.when(right & wrong, F.lit("product:both"))))
    return docs.select("doc_id", F.array_join(errors, ";").alias("errors"), F.array_join(warnings, ";").alias("warnings"), (F.size(errors) == 0).alias("valid"))


def check_contacts(docs: DataFrame, contacts: str, id: str, role: str, roles: list[str], sparse: list[str]) -> DataFrame:
    """Per document, from its array of contacts: missing ids, bad roles, no or many primaries, sparse ones, repeated ids."""
    c = F.coalesce(F.col(contacts), F.array())
    has_id = lambda x: F.coalesce(F.trim(x[id]) != "", F.lit(False))
    primary = F.filter(c, lambda x: has_id(x) & (F.trim(x[role]) == roles[0]))
    thin = F.filter(primary, lambda x: functools.reduce(lambda a, b: a & b, [F.coalesce(F.trim(x[s]) == "", F.lit(True)) for s in sparse]))
    ids = F.transform(F.filter(c, has_id), lambda x: x[id])
    return docs.select(
        "doc_id",
        F.size(F.filter(c, lambda x: ~has_id(x))).alias("missing_id"),
        F.size(F.filter(c, lambda x: ~F.coalesce(F.trim(x[role]).isin(roles), F.lit(False)))).alias("bad_role"),
        (F.size(primary) == 0).alias("no_primary"),
        F.size(thin).alias("sparse_primary"),
        F.greatest(F.lit(0), F.size(primary) - 1).alias("extra_primary"),
        (F.size(ids) - F.size(F.array_distinct(ids))).alias("duplicate_ids"),
    )


def check_children(children: DataFrame, id: str, table: str, type_col: str) -> DataFrame:
    return finding(children, F.coalesce(F.trim(F.col(type_col)) == "", F.lit(True)), id, table, type_col, "child_type", "warning", "skipped: no type")


def validation_summary(checked: DataFrame) -> DataFrame:
    """Totals of pre_validate()."""
    return checked.agg(
        F.count("*").alias("documents"), F.count_if("valid").alias("valid"), F.count_if(~F.col("valid")).alias("invalid"),
        F.count_if(F.col("warnings") != "").alias("with_warnings"),
        F.sum(F.when(F.col("errors") == "", 0).otherwise(F.size(F.split("errors", ";")))).alias("errors"),
    )


def check_fk(child: DataFrame, parent: DataFrame, key: str, id: str, table: str) -> DataFrame:
    """Children whose key the parent lacks; a null key passes."""
    orphans = child.filter(F.col(key).isNotNull()).join(parent.select(key), key, "left_anti")
    return finding(orphans, F.lit(True), id, table, key, "foreign_key", "critical", "no parent")


def check_required(df: DataFrame, id: str, table: str, cols: list[str]) -> DataFrame:
    return findings(df, id, table, [(c, "required", "error", "missing", F.coalesce(F.trim(F.col(c).cast("string")) == "", F.lit(True))) for c in cols])


def check_types(df: DataFrame, id: str, table: str, types: dict[str, str]) -> DataFrame:
    """Text that isn't of its declared type."""
    return findings(
        df, id, table,
        [(c, "type", "error", f"not {t}", F.col(c).isNotNull() & (F.trim(c) != "") & F.trim(c).try_cast(t).isNull()) for c, t in types.items()],
    )


def check_lengths(df: DataFrame, id: str, table: str, limits: dict[str, int]) -> DataFrame:
    return findings(df, id, table, [(c, "length", "error", f"over {n}", F.length(c) > n) for c, n in limits.items()])


def format_rules(now_year: int) -> dict[str, object]:
    """Tests of badly formed values, by kind."""
    digits = lambda c: F.regexp_replace(c, "[^0-9]", "")
    return {
        "ssn": lambda c: ~digits(c).rlike("^[0-9]{9}$") | digits(c).rlike("^([0-9])\\1{8}$"),
        "birth_date": lambda c: ~F.year(F.trim(c).try_cast("date")).between(1900, now_year - 18),
        "email": lambda c: ~(F.contains(c, F.lit("@")) & F.contains(c, F.lit("."))),
        "phone": lambda c: F.length(digits(c)) < 10,
    }


def check_formats(df: DataFrame, id: str, table: str, rules: dict[str, str], now_year: int) -> DataFrame:
    """Badly formed values (column to kind); nulls pass."""
    tests = format_rules(now_year)
    return findings(df, id, table, [(c, "format", "warning", kind, F.col(c).isNotNull() & tests[kind](F.col(c))) for c, kind in rules.items()])


def equivalent(a: Column, b: Column, tolerance: float = 0.01) -> Column:
    """Numbers within a tolerance, else text in any case; two nulls are equal."""
    x, y = F.trim(a.cast("string")), F.trim(b.cast("string"))
    nx, ny = x.try_cast("double"), y.try_cast("double")
    return F.when(nx.isNotNull() & ny.isNotNull(), F.abs(nx - ny) <= tolerance).otherwise(F.lower(x).eqNullSafe(F.lower(y)))


def check_source(src: DataFrame, dst: DataFrame, id: str, fields: list[str]) -> DataFrame:
    """(id, outcome, field): missing and unexpected ids, and fields that differ. One full join."""
    a = src.select(id, F.lit(True).alias("_s"), *[F.col(f).alias(f"s_{f}") for f in fields])
    b = dst.select(id, F.lit(True).alias("_d"), *[F.col(f).alias(f"d_{f}") for f in fields])
    both = a.join(b, id, "full")
    items = F.array(
        F.when(F.col("_d").isNull(), F.struct(F.lit("missing").alias("outcome"), F.lit("").alias("field"))),
        F.when(F.col("_s").isNull(), F.struct(F.lit("unexpected").alias("outcome"), F.lit("").alias("field"))),
        *[F.when(
            F.col("_s") & F.col("_d") & ~equivalent(F.col(f"s_{f}"), F.col(f"d_{f}")),
            F.struct(F.lit("differs").alias("outcome"), F.lit(f).alias("field")),
        ) for f in fields],
    )
    return both.select(id, F.explode(F.array_compact(items)).alias("_x")).select(id, "_x.*")


def quality_metrics(df: DataFrame, cols: list[str], valid: dict[str, Column]) -> DataFrame:
    """Completeness and validity of each column in percent, and a grade by 90 and 80."""
    parts = [F.struct(
        F.lit(c).alias("column_name"), F.round(F.try_divide(100 * F.count(c), F.count("*")), 2).alias("completeness"),
        F.round(F.try_divide(100 * F.count_if(valid.get(c, F.lit(True)) & F.col(c).isNotNull()), F.count(c)), 2).alias("validity"),
    ) for c in cols]
    rows = df.agg(F.array(*parts).alias("_a")).select(F.explode("_a").alias("_x")).select("_x.*")
    least = F.least("completeness", "validity")
    return rows.withColumn("grade", F.when(least >= 90, "good").when(least >= 80, "fair").otherwise("poor"))


def verdict(found: DataFrame, strict: bool) -> DataFrame:
    """passed, and counts by severity. Strict: no error either; else only critical findings count."""
    bad = F.col("severity").isin(["critical", "error"] if strict else ["critical"])
    return found.agg((F.count_if(bad) == 0).alias("passed"), *[F.count_if(F.col("severity") == s).alias(s) for s in ("critical", "error", "warning")])


def report(found: DataFrame, total: DataFrame) -> DataFrame:
    """Per table and check: findings, documents with one, and their share of all documents."""
    n = total.agg(F.count("*").alias("_n"))
    by = found.groupBy("table_name", "check").agg(F.count("*").alias("findings"), F.countDistinct("doc_id").alias("documents"))
    return by.crossJoin(F.broadcast(n)).select(
        "table_name", "check", "findings", "documents", F.round(F.try_divide(100.0 * F.col("documents"), F.col("_n")), 2).alias("pct"),
    )


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def require(df: DataFrame, id: str, table: str, column: str, default: object = None) -> tuple[DataFrame, DataFrame]:
    """(rows, findings) of a text column that must have a value: blank ones get the default; without one, they are findings and go."""
    value = F.nullif(F.trim(column), F.lit(""))
    filled = df.withColumn(column, value if default is None else F.coalesce(value, F.lit(default)))
    lacks = F.col(column).isNull()
    return filled.filter(~lacks), finding(filled, lacks, id, table, column, "required", "critical", "no value and no default")
