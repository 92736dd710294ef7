"""All tables of a contract at once: relationships become explodes and carried keys over one staged parse."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import nonblank
from ..operators import sinks
from ..operators.filters import rule_filter
from ..operators.pick import dedupe_priority
from ..sources.documents import unprocessed
from ..sources.staging import dealt, spread, staged
from .contract import PICKS, ROW_TYPES, Contract, apply_chain, enum_findings, parse, required_findings, source, table, type_name
from .dispatch import record_rows


def insertion_order(contract: Contract) -> list[str]:
    """All target tables, parents before children; else as the contract lists them, those that it doesn't list last."""
    names = list(dict.fromkeys([*contract.order, *sorted({m.target_table for m in contract.mappings})]))
    names = [n for n in names if any(m.target_table == n for m in contract.mappings)]
    parents = {n: {r.parent_table for r in contract.relationships if r.child_table == n and r.parent_table != n} & set(names) for n in names}
    out: list[str] = []
    while len(out) < len(names):
        free = next((n for n in names if n not in out and parents[n] <= set(out)), None)
        if free is None:
            raise ValueError(f"relationships form a circle among {sorted(set(names) - set(out))}")
        out.append(free)
    return out


class FanOut:
    """Where each table's rows come from in shredded documents (id, d), and the tables themselves.

    A child table of a relationship has a row for each element at its XML path; other tables have one for each document.
    Repeated elements on the way are exploded, each level once for all tables that need it, and carry what is above them.
    A level with a filter rule keeps the elements that the rule holds for, and so their children; types are told in any
    case, but those of parties as the contract writes them. Where the contract's
    parties are a table, it has one row for each of their ids in a document: of the preferred type, and of equals the last.
    """

    def __init__(self, rows: DataFrame, contract: Contract, id: str = "doc_id") -> None:
        self.rows, self.contract, self.id = rows, contract, id
        self.levels: dict[tuple[str, ...], DataFrame] = {}

    def home(self, name: str) -> str | None:
        """The path whose elements are the table's rows; None for documents."""
        paths = {r.xml_child_path for r in self.contract.relationships if r.child_table == name}
        if len(paths) > 1:
            raise ValueError(f"table {name}: its relationships name several child paths")
        return paths.pop().rstrip("/") if paths else None

    def repeats(self, path: str | None) -> tuple[str, ...]:
        """The repeated elements on the way to a path, outermost first."""
        steps = (path or "").strip("/").split("/")
        prefixes = ["/" + "/".join(steps[: i + 1]) for i in range(len(steps))]
        return tuple(p for p in prefixes if p in self.contract.repeated)

    @staticmethod
    def column(path: str, exploded: tuple[str, ...]) -> str:
        """The column that holds a path's element (or the array of them), seen from a level."""
        inner = [(i, p) for i, p in enumerate(exploded) if path == p or path.startswith(f"{p}/")]
        if inner:
            i, p = inner[-1]
            return f"_e{i}" + path[len(p) :].replace("/", ".")
        rest = path.strip("/").split("/")[1:]
        return ".".join(["d", *rest])

    def at(self, exploded: tuple[str, ...]) -> dict[str, str]:
        paths = {m.xml_path for m in self.contract.mappings} | set(self.contract.filters)
        return {p: self.column(p.rstrip("/"), exploded) for p in paths}

    def is_party(self, path: str) -> bool:
        return any(isinstance(r, list) for r in self.contract.filters.get(path, {}).values()) and path == self.contract.party_path()

    def level(self, exploded: tuple[str, ...]) -> DataFrame:
        """Shredded documents with a row for each of the last path's elements: id, d, and for each path its element and place."""
        if exploded not in self.levels:
            if not exploded:
                self.levels[exploded] = self.rows.select(self.id, "d")
            else:
                above, n = self.level(exploded[:-1]), len(exploded) - 1
                rows = above.select("*", F.posexplode(self.column(exploded[-1], exploded[:-1])).alias(f"_p{n}", f"_e{n}"))
                rule = self.contract.filters.get(exploded[-1], {})
                self.levels[exploded] = rule_filter(rows, {f"_e{n}._{a}": r for a, r in rule.items()}, strict=self.is_party(exploded[-1]))
        return self.levels[exploded]

    def foreign_keys(self, name: str, exploded: tuple[str, ...]) -> dict[str, Column]:
        """The child's key columns: what the parent's own mapping of that column gives, seen from the child's level."""
        own = {m.target_column for m in self.contract.mappings if m.target_table == name}
        out: dict[str, Column] = {}
        for r in self.contract.relationships:
            key = r.foreign_key_column
            if r.child_table != name or key in own or key in out:
                continue
            mapping = next((m for m in self.contract.mappings if m.target_table == r.parent_table and m.target_column == key), None)
            if mapping is None and key != self.id:
                raise ValueError(f"table {name}: {r.parent_table} has no column {key}")
            out[key] = F.col(self.id) if mapping is None else apply_chain(source(mapping, self.contract, self.at(exploded)), mapping, self.contract)
        return out

    def is_records(self, name: str) -> bool:
        return any(type_name(t)[0] in ROW_TYPES for m in self.contract.mappings if m.target_table == name for t in m.mapping_type)

    def elements(self, name: str) -> tuple[DataFrame, tuple[str, ...], dict[str, Column]]:
        """(rows of a table before they are mapped, the level's paths, key columns)."""
        path = self.home(name)
        exploded = self.repeats(path)
        for m in self.contract.mappings:
            if m.target_table == name and m.xml_attribute and not any(t in PICKS for t in m.mapping_type) and not set(self.repeats(m.xml_path.rstrip("/"))) <= set(exploded):
                raise ValueError(f"table {name}: {m.xml_path} repeats, so a relationship must say that its elements are the table's rows")
        if any(t in PICKS[:3] for m in self.contract.mappings if m.target_table == name for t in m.mapping_type) and exploded:
            raise ValueError(f"table {name}: a pick among a document's parties needs a row for each document")
        df, keys, made = self.level(exploded), self.foreign_keys(name, exploded), False
        if path and path not in exploded:
            df = df.filter(F.col(self.column(path, exploded)).isNotNull())
        if exploded and path in self.contract.filters and self.is_party(path):
            key, type_attr, types = self.contract.typed_rule(path)
            last = f"_e{len(exploded) - 1}"
            if key:
                marked = self.narrow(df.withColumns({**keys, "_key": F.trim(f"{last}._{key}"), "_type": F.trim(f"{last}._{type_attr}")}), name, exploded)
                df = dedupe_priority(spread(marked, self.id), [self.id, "_key"], "_type", types, *[f"_p{i}" for i in range(len(exploded))]).drop("_key", "_type")
                made = True
        df = df.withColumns(keys) if keys and not made else df
        for key in keys:  # children whose parent has no key are no rows
            df = df.filter(nonblank(F.col(key)))
        return df, exploded, keys

    def narrow(self, df: DataFrame, name: str, exploded: tuple[str, ...]) -> DataFrame:
        """Rows before they are shuffled: of elements, only the attributes that a table's mappings take. Spark doesn't prune structs through a repartition."""
        own = [m for m in self.contract.mappings if m.target_table == name and m.xml_attribute]
        picks = any(t in PICKS for m in own for t in m.mapping_type)
        for whole in ["d", *[f"_e{i}" for i in range(len(exploded))]]:
            used = [(c, m.xml_attribute) for m in own for c in [self.column(m.xml_path.rstrip("/"), exploded)] if c.split(".")[0] == whole]
            if picks or any(c != whole for c, _ in used):
                continue
            taken = dict.fromkeys(a for _, a in used)
            df = df.withColumn(whole, F.struct(*[F.col(f"{whole}._{a}").alias(f"_{a}") for a in taken])) if taken else df.drop(whole)
        return df

    def table(self, name: str) -> DataFrame:
        if self.is_records(name):
            return record_rows(self.rows, self.contract, name, self.at(()), self.id)
        df, exploded, keys = self.elements(name)
        return table(df, self.contract, name, self.at(exploded), [self.id, *[k for k in keys if k != self.id]])

    def findings(self, name: str) -> DataFrame | None:
        """Critical ones for required columns without a value, warnings for values that their enum lacks."""
        if self.is_records(name):
            return None
        df, exploded, keys = self.elements(name)
        at = self.at(exploded)
        made = table(df, self.contract, name, at, [self.id, *[k for k in keys if k != self.id]])
        out = []
        if any(m.target_table == name and not m.nullable and m.target_column for m in self.contract.mappings):
            out.append(required_findings(made, self.contract, name, self.id))
        if any(m.target_table == name and m.nullable and m.mapping_type[-1:] == ["enum"] for m in self.contract.mappings):
            out.append(enum_findings(df, self.contract, name, at, self.id))
        return functools.reduce(DataFrame.unionByName, out) if out else None


@dataclass
class Mapped:
    """Tables, parents first, and the findings about their rows."""

    tables: dict[str, DataFrame]
    findings: DataFrame


def fan_out(docs: DataFrame, contract: Contract, id: str = "doc_id", keep: dict[str, Callable[[DataFrame], DataFrame]] | None = None) -> Mapped:
    """Map documents (doc_id, xml) to every table of a contract. They are parsed once, into a staged table of the contract's paths.

    `keep` filters the mapped rows of a table, such as those of addresses without a meaningful value.
    """
    return map_rows(staged(parse(docs, contract), "fanout-rows"), contract, id, keep)


def map_rows(rows: DataFrame, contract: Contract, id: str = "doc_id", keep: dict[str, Callable[[DataFrame], DataFrame]] | None = None) -> Mapped:
    """fan_out() of documents that are already shredded and staged."""
    plan = FanOut(rows, contract, id)
    tables = {n: (keep or {}).get(n, lambda df: df)(plan.table(n)) for n in insertion_order(contract)}
    found = [f for f in map(plan.findings, tables) if f is not None]
    empty = rows.sparkSession.createDataFrame([], "doc_id long, table_name string, field string, check string, severity string, message string")
    return Mapped(tables, functools.reduce(DataFrame.unionByName, found) if found else empty)


def load(
    docs: DataFrame, contract: Contract, path: str, session: str, run: str | None = None, id: str = "doc_id", unique: bool = True, retry_failed: bool = False,
    keep: dict[str, Callable[[DataFrame], DataFrame]] | None = None,
) -> str:
    """Map new documents to all tables of a contract and commit them under path; returns the run's id.

    Documents that the log there names are left out (with retry_failed, only those that it calls a success). What isn't
    well formed, or lacks a required value anywhere, fails as a whole and is logged with its stage and reason. Rows come
    first and the log last, so a run that dies at any point is simply run again: none of its rows is seen, and no
    document is seen twice. Without `unique`, ids may repeat in docs, and one document of each is taken.
    """
    spark = docs.sparkSession
    run = run or uuid.uuid4().hex
    if not unique:
        docs = docs.dropDuplicates([id])
    if sinks.exists(spark, f"{path}/processing_log"):
        log = spark.read.parquet(f"{path}/processing_log")
        docs = unprocessed(spread(docs, id), log.select(F.col("app_id").alias(id), "status"), id, retry_failed)
    # the log may grow while this runs again, so what is taken is fixed first
    rows = staged(with_status(docs, contract, id), "load-rows")
    good = rows.filter("d is not null").select(id, "d")
    mapped = map_rows(good, contract, id, keep)
    broken = rows.filter("d is null").select(id, F.lit("parsing").alias("stage"), F.lit("not well formed").alias("message"))
    failed = staged(sinks.failures(mapped.findings).withColumnRenamed("doc_id", id).unionByName(broken), "load-failed")
    ok = good.select(id).join(dealt(failed.select(id)), id, "left_anti")
    sinks.commit_documents(mapped.tables, failed, sinks.log_outcomes(ok, failed, session, id), list(mapped.tables), path, id, run)
    return run


def with_status(docs: DataFrame, contract: Contract, id: str = "doc_id") -> DataFrame:
    """(id, d): all documents, with a null d where one isn't well formed."""
    from ..operators.shred import PERMISSIVE, with_corrupt

    schema = contract.schema()
    parsed = docs.select(id, F.explode(F.array(F.from_xml("xml", with_corrupt(schema), PERMISSIVE))).alias("d"))
    whole = F.col("d").isNotNull() & F.col("d._corrupt_record").isNull()
    return parsed.select(id, F.when(whole, F.struct(*[F.col(f"d.`{f.name}`") for f in schema.fields])).alias("d"))


def outcomes(spark: SparkSession, path: str) -> DataFrame:
    """(app_id, status, failure_reason, session_id) of a folder that load() has filled."""
    return spark.read.parquet(f"{path}/processing_log").drop(sinks.RUN)
