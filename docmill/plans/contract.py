"""Mapping contracts: what a document's attributes become, as schemas, filters and Column expressions."""

from __future__ import annotations

import functools
import json
import operator
import re
from collections.abc import Callable
from dataclasses import dataclass, field, fields, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import casts
from ..functions.calculated import calc
from ..operators.shred import shred
from ..sources.staging import dealt, staged


@dataclass
class Mapping:
    """One attribute to one column. mapping_type is a chain that is applied from left to right."""

    xml_path: str
    xml_attribute: str
    target_table: str
    target_column: str
    data_type: str = "string"
    data_length: int | None = None
    mapping_type: list[str] = field(default_factory=list)
    default_value: object = None
    expression: str | None = None
    nullable: bool = True
    enum_name: str | None = None
    exclude_default_when_record_empty: bool = False
    description: str = ""

    def __post_init__(self) -> None:
        if isinstance(self.mapping_type, str):
            self.mapping_type = [t.strip() for t in self.mapping_type.split(",") if t.strip()]


@dataclass(frozen=True)
class Relationship:
    """A child table's rows are the elements at a path below the parent's; a column holds the parent's value of that name."""

    parent_table: str
    child_table: str
    foreign_key_column: str
    xml_parent_path: str
    xml_child_path: str


@dataclass
class Contract:
    root: str
    application_path: str
    repeated: list[str]
    mappings: list[Mapping]
    filters: dict[str, dict[str, bool | list[str]]] = field(default_factory=dict)
    enums: dict[str, dict[str, int]] = field(default_factory=dict)
    bits: dict[str, dict[str, int]] = field(default_factory=dict)
    order: list[str] = field(default_factory=list)
    keys: list[str] = field(default_factory=lambda: ["app_id", "con_id"])  # columns that say nothing of a record by themselves
    relationships: list[Relationship] = field(default_factory=list)

    @classmethod
    def load(cls, text: str) -> Contract:
        """From JSON; unknown keys are ignored."""
        raw = json.loads(text)
        known = {f.name for f in fields(Mapping)}
        return cls(
            raw["xml_root_element"], raw["xml_application_path"], raw.get("repeated_paths", []), [Mapping(**{k: v for k, v in m.items() if k in known}) for m in raw["mappings"]],
            {f["xml_child_path"]: f["required_attributes"] for f in raw.get("element_filtering", {}).get("filter_rules", [])},
            raw.get("enum_mappings", {}), raw.get("bit_conversions", {}), raw.get("table_insertion_order", []),
            relationships=[Relationship(**{f.name: r[f.name] for f in fields(Relationship)}) for r in raw.get("relationships", [])],
        )

    def codes(self, m: Mapping) -> dict[str, int]:
        """The codes of an enum column: by the mapping's name, else by the column's; none where no list fits, so all values are unknown."""
        column = m.target_column
        by_pattern = column if column.endswith("_enum") else next((e for part, e in ENUM_PATTERNS.items() if part in column), None)
        return self.enums.get(m.enum_name or by_pattern or "", {})

    def typed_rule(self, path: str) -> tuple[str | None, str, list[str]]:
        """Of a path's filter rule: the attribute that must have a value, the one that must be a type, and the types, preferred first."""
        rule = self.filters[path]
        name, types = next((a, r) for a, r in rule.items() if isinstance(r, list))
        return next((a for a, r in rule.items() if r is True), None), name, types

    def party_path(self) -> str:
        """Where the parties of a document are: the outermost path that has a filter rule with types."""
        return min((p for p, rule in self.filters.items() if any(isinstance(r, list) for r in rule.values())), key=lambda p: (p.count("/"), p))

    def unknown_types(self) -> list[tuple[str, str, str]]:
        """(table, column, mapping type) of mappings with a type that is neither known nor registered. They are plain casts."""
        known = {*CHAIN_TYPES, *PICKS, *CUSTOM}
        return [(m.target_table, m.target_column, t) for m in self.mappings for t in m.mapping_type if t not in known and type_name(t)[0] not in ROW_TYPES]

    def schema(self, *tables: str) -> T.StructType:
        """A schema that has the paths of the mappings and filters, and no more: from_xml then builds nothing else.

        With names of tables, it has what these take from a document, by picks among parties, too.
        """
        tree: dict = {}
        mappings = [m for m in self.mappings if not tables or m.target_table in tables]
        filtered = not tables or any(t in PICKS for m in mappings for t in m.mapping_type)
        wanted = [(m.xml_path, m.xml_attribute) for m in mappings] + [(p, a) for p, rule in self.filters.items() for a in rule if filtered]
        for path, attribute in wanted:
            node = tree
            for step in path.strip("/").split("/")[1:]:
                node = node.setdefault(step, {})
            if attribute:
                node[f"_{attribute}"] = None

        def build(node: dict, path: str) -> T.StructType:
            out = []
            for name, inner in node.items():
                kind: T.DataType = T.StringType()
                if inner is not None:
                    here = f"{path}/{name}"
                    kind = build(inner, here)
                    kind = T.ArrayType(kind) if here in self.repeated else kind
                out.append(T.StructField(name, kind))
            return T.StructType(out)

        return build(tree, f"/{self.root}")


#: Fixed values of the contract format: parts of column names, in the order in which they are looked for, and the lists of codes that they stand for.
ENUM_PATTERNS = {
    "status": "status_enum",
    "process": "process_enum",
    "app_source": "app_source_enum",
    "contact_type": "contact_type_enum",
    "address_type": "address_type_enum",
    "ownership_type": "ownership_type_enum",
    "employment_type": "employment_type_enum",
    "income_type": "income_type_enum",
    "other_income_type": "other_income_type_enum",
    "population_assignment": "population_assignment_enum",
    "decision": "decision_enum",
}
#: Fixed values of the contract format: mapping types of one value, of one party among several, and those that make rows.
CHAIN_TYPES = ("calculated_field", "enum", "char_to_bit", "boolean_to_bit", "extract_numeric", "numbers_only", "first_number", "default_now", "identity_insert")
PICKS = ("last_valid_pr_contact", "last_valid_sec_contact", "authu_contact", "curr_address_only")
ROW_TYPES = ("add_score", "add_indicator", "add_history", "add_report_lookup", "policy_exceptions", "warranty_field", "add_collateral")


def type_name(t: str) -> tuple[str, str | None]:
    """A mapping type's name, and what stands in its brackets (None without brackets)."""
    found = re.match(r"(\w+)\(([^)]*)\)$", t.strip())
    return (found[1], found[2].strip()) if found else (t.strip(), None)


#: Mapping types that users add: name to f(column, mapping, contract).
CUSTOM: dict[str, Callable[[Column, Mapping, Contract], Column]] = {}


def register(name: str, function: Callable[[Column, Mapping, Contract], Column]) -> None:
    """Make a mapping type usable in any chain."""
    CUSTOM[name] = function


def apply_chain(c: Column, m: Mapping, contract: Contract, resolve: Callable[[str], Column] | None = None) -> Column:
    """A mapping's chain and its final cast. A null stops the chain, but not before an enum, nor after one or default_now.

    A calculated field followed by an enum falls back to the enum of the raw value where the calculation gives nothing.
    """
    raw, types = c, [t for t in m.mapping_type if t not in PICKS and type_name(t)[0] not in ROW_TYPES]
    if not m.mapping_type:
        return direct(c, m)
    if not types:
        return with_contract_default(casts.cast_to(c, m.data_type, m.data_length), m)
    for i, t in enumerate(types):
        if t == "calculated_field":
            c = calc(m.expression or "", resolve or (lambda name: F.col(name))).cast("string")
            continue
        if t == "enum":
            codes = contract.codes(m)
            default = m.default_value if not m.nullable else None
            if i and types[i - 1] == "calculated_field":
                made = casts.blank_to_null(c)
                c = F.coalesce(made.try_cast("int"), casts.enum_code(raw, codes, default))
            else:
                c = casts.enum_code(c.cast("string"), codes, default)
            continue
        step = _step(t, c, m, contract)
        c = step if t == "default_now" or t == "char_to_bit" or t == "boolean_to_bit" else F.when(c.isNotNull(), step)
    done = {"enum": "int", "char_to_bit": "int", "boolean_to_bit": "int"}.get(types[-1])
    out = c if done or types[-1] == "default_now" else casts.cast_to(c.cast("string"), m.data_type, m.data_length)
    return with_contract_default(out, m)


def _step(t: str, c: Column, m: Mapping, contract: Contract) -> Column:
    if t in CUSTOM:
        return CUSTOM[t](c, m, contract)
    if t == "char_to_bit":
        return casts.char_to_bit(c, contract.bits["char_to_bit"])
    if t == "boolean_to_bit":
        return casts.boolean_to_bit(c, contract.bits["boolean_to_bit"])
    if t in ("extract_numeric", "numbers_only"):
        return casts.digits(c)
    if t == "first_number":
        return casts.first_number(c).cast("string")
    if t == "default_now":
        return casts.default_now(c, str(m.default_value))
    return c  # an unknown type is a plain cast


def direct(c: Column, m: Mapping) -> Column:
    """No chain: numbers inside text for whole-number targets, the cast, the default."""
    if m.data_type in casts.WHOLE:
        plain = casts.to_int(c, m.data_type)
        found = F.round(casts.first_number(c), 0).try_cast(m.data_type)
        c = F.coalesce(plain, found)
    else:
        c = casts.cast_to(c, m.data_type, m.data_length)
    return with_contract_default(c, m)


def with_contract_default(c: Column, m: Mapping) -> Column:
    """The contract's default where nothing came of the source. An enum that may be null stays null: a missing code isn't a default one."""
    if m.default_value is None or "default_now" in m.mapping_type or (m.nullable and "enum" in m.mapping_type):
        return c
    return F.coalesce(c, F.lit(m.default_value).cast(_spark_type(m)))


def _spark_type(m: Mapping) -> str:
    if m.data_type in casts.WHOLE:
        return m.data_type
    return {"integer": "int", "decimal": f"decimal(38,{2 if m.data_length is None else m.data_length})", "float": "double", "datetime": "timestamp_ntz", "date": "timestamp_ntz", "smalldatetime": "timestamp_ntz", "bit": "int", "boolean": "boolean"}.get(m.data_type, "string")


def parse(docs: DataFrame, contract: Contract, *tables: str) -> DataFrame:
    """Documents as structs with what the contract takes from them, or what these tables of it take."""
    return shred(docs, contract.schema(*tables))


def source(m: Mapping, contract: Contract, at: dict[str, str]) -> Column:
    """A mapping's source value, trimmed: an attribute of the element at its path, or of the party that its type picks."""
    from .dispatch import pick

    kinds = [t for t in m.mapping_type if t in PICKS]
    if kinds:
        return F.trim(pick(kinds[0], m, contract, at))
    return F.trim(F.col(f"{at[m.xml_path]}._{m.xml_attribute}")) if m.xml_attribute else F.lit(None).cast("string")


def table(rows: DataFrame, contract: Contract, name: str, at: dict[str, str], keys: list[str], resolve: Callable[[str], Column] | None = None) -> DataFrame:
    """A target table from shredded rows; `at` says which column holds each XML path's element.

    A default that is marked exclude_default_when_record_empty stays away from records with fewer than two values that
    are neither keys nor defaults.
    """
    mappings = [m for m in contract.mappings if m.target_table == name and m.target_column]
    made = {m.target_column: apply_chain(source(m, contract, at), m, contract, resolve) for m in mappings}
    conditional = [m for m in mappings if m.exclude_default_when_record_empty and m.default_value is not None]
    if conditional:
        own = {m.target_column: made[m.target_column] if m.default_value is None else apply_chain(source(m, contract, at), replace(m, default_value=None), contract, resolve) for m in mappings}
        said = functools.reduce(operator.add, [own[c].isNotNull().cast("int") for c in own if c not in contract.keys], F.lit(0))
        for m in conditional:
            made[m.target_column] = F.when(said >= 2, made[m.target_column]).otherwise(own[m.target_column])
    return rows.select(*keys, *[c.alias(n) for n, c in made.items()])


def checked_table(rows: DataFrame, contract: Contract, name: str, at: dict[str, str], keys: list[str], id: str = "doc_id", resolve: Callable[[str], Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """(table, findings): a document with a row that lacks a value for a required column without default is in no row of the table.

    The mapped rows are staged, so documents are parsed once for both.
    """
    made = staged(table(rows, contract, name, at, keys, resolve), f"mapped-{name}")
    found = required_findings(made, contract, name, id)
    return made.join(dealt(found.select(id).distinct()), id, "left_anti"), found


def required_findings(rows: DataFrame, contract: Contract, name: str, id: str) -> DataFrame:
    """Rows without a value for a column that may not be null: the document fails."""
    from ..operators.quality import findings

    cols = [m.target_column for m in contract.mappings if m.target_table == name and not m.nullable and m.target_column]
    return findings(rows, id, name, [(c, "required", "critical", "no value and no default", F.col(c).isNull()) for c in cols])


def enum_findings(rows: DataFrame, contract: Contract, name: str, at: dict[str, str], id: str) -> DataFrame:
    """Values that their enum's codes lack, where the column may be null: the document stays, and the value is reported."""
    from ..operators.quality import findings

    enums = [m for m in contract.mappings if m.target_table == name and m.mapping_type[-1:] == ["enum"] and m.nullable]
    tests = []
    for m in enums:
        value = source(m, contract, at).cast("string")
        tests.append((m.target_column, "enum", "warning", "no code for the value", casts.nonblank(value) & apply_chain(source(m, contract, at), m, contract).isNull()))
    return findings(rows, id, name, tests)
