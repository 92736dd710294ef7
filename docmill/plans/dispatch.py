"""Mapping types that need more than one value: picks among a document's parties, and rows from several columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import casts
from ..operators import rows as r
from .contract import ROW_TYPES, Contract, Mapping, apply_chain, source, type_name


def _last(elements: Column) -> Column:
    return F.try_element_at(elements, F.lit(-1))


def _children(parent: Column, name: str, repeated: bool) -> Column:
    return parent[name] if repeated else F.when(parent[name].isNotNull(), F.array(parent[name]))


def pick(kind: str, m: Mapping, contract: Contract, at: dict[str, str]) -> Column:
    """The attribute of a mapping, of the party or address that a mapping type picks.

    Types come from the contract's filter rules, preferred first. last_valid_pr_contact: the last party of the first
    type that has an id; last_valid_sec_contact: of the second type; authu_contact: of the second type, id or not. For
    these, `at` has the array of parties. Paths below a party: of addresses those of the preferred type, if any; the
    first of them that has the attribute, else the last. Of other children the last. A mapping that makes history falls
    back on the last party of the type that has a meaningful value. curr_address_only: the last address of the preferred
    type, of the party that `at` has; nothing if it has none.
    """
    path = contract.party_path()
    id, type_attr, types = contract.typed_rule(path)
    party, name = F.col(at[path]), f"_{m.xml_attribute}"
    if kind == "curr_address_only":
        child = m.xml_path.rsplit("/", 1)[1]
        _, child_type, child_types = contract.typed_rule(m.xml_path)
        return _last(F.filter(_children(party, child, m.xml_path in contract.repeated), lambda x: F.trim(x[f"_{child_type}"]) == child_types[0]))[name]
    wanted = types[0] if kind == "last_valid_pr_contact" else types[1]

    def of_type(x: Column) -> Column:
        there = F.trim(x[f"_{type_attr}"]) == wanted
        return there if kind == "authu_contact" or id is None else there & casts.nonblank(x[f"_{id}"])

    parties = F.filter(party, of_type)
    chosen = _last(parties)
    if m.xml_path == path:
        value = chosen[name]
        if any(type_name(t)[0] == "add_history" for t in m.mapping_type):
            value = F.when(casts.meaningful(value), value).otherwise(_last(F.filter(parties, lambda x: casts.meaningful(x[name])))[name])
        return value
    children = _children(chosen, m.xml_path.rsplit("/", 1)[1], m.xml_path in contract.repeated)
    if m.xml_path not in contract.filters:
        return _last(children)[name]
    _, child_type, child_types = contract.typed_rule(m.xml_path)
    preferred = F.filter(children, lambda x: F.trim(x[f"_{child_type}"]) == child_types[0])
    among = F.when(F.size(preferred) > 0, preferred).otherwise(children)
    return F.coalesce(F.get(F.filter(among, lambda x: casts.nonblank(x[name])), 0)[name], _last(among)[name])


#: Kinds of key-value mapping types, and the columns of their tables that are a row's name and value.
KV_KINDS = {"add_score": ("score_identifier", "score"), "add_indicator": ("indicator", "value"), "add_history": ("name", "value"), "add_report_lookup": ("name", "value")}


def kv_mappings(contract: Contract, name: str) -> list[tuple[Mapping, str, str | None]]:
    """(mapping, kind, what stands in its brackets) of a key-value table's mappings that can make a row."""
    out = []
    for m in contract.mappings:
        kind, of = next((type_name(t) for t in m.mapping_type if type_name(t)[0] in KV_KINDS), ("", None))
        if m.target_table == name and m.xml_attribute and kind and (of or kind in ("add_history", "add_report_lookup")):
            out.append((m, kind, of))
    return out


def kv_source(rows: DataFrame, contract: Contract, names: list[str], at: dict[str, str], id: str = "doc_id") -> DataFrame:
    """What a contract's key-value mappings should make of each document, straight from its attributes, in one pass.

    (id, table_name, name, source, attribute, raw, expected), a row for each mapping: raw is the attribute's text, expected
    the value that should be stored, null where none should. name and source are the stored row's key.
    """
    items = []
    for table_name in names:
        for m, kind, of in kv_mappings(contract, table_name):
            raw = source(m, contract, at)
            last = m.xml_path.rstrip("/").rsplit("/", 1)[-1]
            name = {"add_history": f"[{m.xml_attribute}]", "add_report_lookup": m.xml_attribute}.get(kind, of)
            value = F.when(casts.meaningful(raw), raw)
            if kind == "add_score":
                value = F.round(F.trim(raw).try_cast("decimal(38,10)"), 0).try_cast("int").cast("string")
            elif kind == "add_indicator":
                value = F.when(F.lower(raw).isin("y", "yes", "true", "t", "1"), "1")
            items.append(F.struct(
                F.lit(table_name).alias("table_name"), F.lit(name).alias("name"), F.lit(f"[{last}]" if kind == "add_history" else None).cast("string").alias("source"),
                F.lit(m.xml_attribute).alias("attribute"), raw.alias("raw"), value.alias("expected"),
            ))
    return rows.select(id, F.explode(F.array(*items)).alias("_x")).select(id, "_x.*")


def kv_side(df: DataFrame, table_name: str, id: str = "doc_id") -> DataFrame:
    """Rows of a key-value table, mapped or stored, as (id, table_name, name, source, value)."""
    name, value = next((n, v) for n, v in KV_KINDS.values() if n in df.columns and v in df.columns)
    origin = F.col("source") if "source" in df.columns else F.lit(None).cast("string")
    return df.select(id, F.lit(table_name).alias("table_name"), F.col(name).alias("name"), origin.alias("source"), F.col(value).cast("string").alias("value"))


def kv_issues(contract: Contract, tables: dict[str, str]) -> list[tuple[str, str, str]]:
    """(table, attribute, what is odd) of key-value mappings: a type that its table doesn't take, or a score kept as history. tables: name to kind."""
    out = []
    for m in contract.mappings:
        if m.target_table not in tables:
            continue
        want = tables[m.target_table]
        if want not in {type_name(t)[0] for t in m.mapping_type}:
            out.append((m.target_table, m.xml_attribute, f"no {want} among its mapping types"))
        if want == "add_history" and m.xml_attribute.lower().endswith("_score"):
            out.append((m.target_table, m.xml_attribute, "a score that is kept as history"))
    return out


def record_rows(rows: DataFrame, contract: Contract, name: str, at: dict[str, str], id: str = "doc_id", amounts: tuple[str, ...] = ("wholesale_value",)) -> DataFrame:
    """The rows that a contract's row-creating mapping types make for a table, in one pass over shredded documents.

    add_score(name), add_indicator(name), add_history, add_report_lookup(key): key-value rows. policy_exceptions(type): a
    row for each type that has a reason; policy_exceptions() has the notes of all. warranty_field(type) and
    add_collateral(slot): a row for each type or slot with a value that is neither a flag nor calculated, nor an amount
    of 0 alone; flags are 0 without a value.
    """
    found = [(m, *next((type_name(t) for t in m.mapping_type if type_name(t)[0] in ROW_TYPES), ("", None))) for m in contract.mappings if m.target_table == name]
    found = [(m, kind, of) for m, kind, of in found if kind]
    kinds = {kind for _, kind, _ in found}
    if len(kinds) != 1:
        raise ValueError(f"table {name}: one kind of row-creating mapping is needed, found {sorted(kinds)}")
    kind = kinds.pop()
    if kind in ("add_score", "add_indicator", "add_history", "add_report_lookup"):
        specs, values = [], {}
        for i, (m, _, of) in enumerate(found):
            if m.xml_attribute and (of or kind in ("add_history", "add_report_lookup")):
                values[f"v{i}"] = source(m, contract, at)
                shown = {"add_history": m.xml_path.rstrip("/").rsplit("/", 1)[-1], "add_report_lookup": m.xml_attribute}.get(kind, of)
                specs.append((f"v{i}", shown, m.xml_attribute if kind == "add_history" else of))
        wide = rows.select(id, *[c.alias(n) for n, c in values.items()])
        return r.kv_rows(wide, id, specs, {"add_score": "score", "add_indicator": "indicator", "add_history": "history", "add_report_lookup": "report"}[kind])
    groups: dict[int, dict[str, Column]] = {}
    flags, derived, notes = set(), set(), None
    for m, _, of in found:
        value = source(m, contract, at)
        value = F.when(casts.meaningful(value), value)
        if kind == "policy_exceptions":
            if of:
                groups.setdefault(int(of), {})["reason_code"] = value
            else:
                notes = value
            continue
        if not of:
            continue
        if "char_to_bit" in m.mapping_type:
            flags.add(m.target_column)
        if "calculated_field" in m.mapping_type:
            derived.add(m.target_column)
        groups.setdefault(int(of), {})[m.target_column] = apply_chain(value, m, contract)
    if kind == "policy_exceptions":
        made = r.group_rows(rows, id, groups, ["reason_code"], {"notes": F.lit(None).cast("string") if notes is None else notes})
        return made.withColumnRenamed("type", "policy_exception_type_enum")
    columns = list(dict.fromkeys(c for fields in groups.values() for c in fields))
    types = dict(rows.select(*[next(f[c] for f in groups.values() if c in f).alias(c) for c in columns]).dtypes)
    full = {of: {c: fields.get(c, F.lit(None)).cast(types[c]) for c in columns} for of, fields in sorted(groups.items())}
    amount = [c for c in columns if c in amounts]
    made = r.group_rows(rows, id, full, [c for c in columns if c not in flags | derived | set(amount)], None, dict.fromkeys(sorted(flags), 0), amount)
    return made.withColumnRenamed("type", "warranty_type_enum" if kind == "warranty_field" else "sort_order")
