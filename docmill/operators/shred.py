"""XML documents to nested columns, and nested columns to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}


def clean_xml(c: Column) -> Column:
    """Without byte order marks (also as three Latin characters) and leading control characters; line ends as LF; trimmed."""
    # patterns only where a document begins with something else than a tag: they read it to its end
    c = F.when(c.startswith("<"), c).otherwise(F.regexp_replace(c, r"^(﻿|ï»¿)*[\x00-\x08\x0B\x0C\x0E-\x1F]*", ""))
    c = F.replace(F.replace(c, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return F.trim(c, F.lit(" \t\n\x0b\f\r"))


def schema_of(tree: dict) -> T.StructType:
    """A schema from nested names: None is text, a dict an element, a list of one dict a repeated element."""

    def kind(x) -> T.DataType:
        if x is None:
            return T.StringType()
        return T.ArrayType(schema_of(x[0])) if isinstance(x, list) else schema_of(x)

    return T.StructType([T.StructField(n, kind(x)) for n, x in tree.items()])


def pruned(schema: T.StructType, *paths: str) -> T.StructType:
    """The schema with these paths of names alone, and all that is below them."""
    out = []
    for f in schema.fields:
        below = [p.partition(".")[2] for p in paths if p.partition(".")[0] == f.name]
        if below and all(below):
            array = isinstance(f.dataType, T.ArrayType)
            inner = pruned(f.dataType.elementType if array else f.dataType, *below)
            f = T.StructField(f.name, T.ArrayType(inner) if array else inner)
        out += [f] if below else []
    return T.StructType(out)


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])


def xml_status(docs: DataFrame, root: str, schema: T.StructType) -> DataFrame:
    """doc_id and the first check that a document fails: starts, ends, root, closes, well_formed; else ok."""
    x = F.col("xml")
    head = F.lower(F.substring(x, 1, 100))
    parsed = F.from_xml(x, with_corrupt(schema), PERMISSIVE)
    status = (
        F.when(x.isNull() | (F.trim(x) == ""), "empty")
        .when(~x.startswith("<"), "starts")
        .when(~x.endswith(">"), "ends")
        .when(F.instr(head, f"<{root.lower()}") == 0, "root")
        .when(~F.contains(x, F.lit(f"</{root}>")) & (F.instr(F.lower(x), f"</{root.lower()}>") == 0), "closes")
        .when(parsed["_corrupt_record"].isNotNull(), "well_formed")
        .otherwise("ok")
    )
    return docs.select("doc_id", status.alias("status"))


def strip_namespaces(c: Column) -> Column:
    """XML without namespace declarations, and without prefixes of elements and attributes. What stands in quotes stays as it is."""
    c = F.regexp_replace(c, r"""\sxmlns(:[\w.-]+)?\s*=\s*("[^"]*"|'[^']*')""", "")
    c = F.regexp_replace(c, r"(</?)[\w.-]+:(?=[\w.-])", "$1")
    # attributes: from a tag's beginning or the last one's end, over names and whole quoted values
    return F.regexp_replace(c, r"""((?:<|\G(?!\A))[^<>"']*?(?:"[^"]*"[^<>"']*?|'[^']*'[^<>"']*?)*?\s)[\w.-]+:(?=[\w.-]+\s*=)""", "$1")


def shred(docs: DataFrame, schema: T.StructType, namespaces: bool = True) -> DataFrame:
    """doc_id and the struct `d` of those documents that are well formed; only paths of the schema are built.

    Without namespaces, names in documents are taken without their prefixes.

    Stage or persist the result before several tables are made from it, or each will parse again.
    """
    # explode keeps the parse where it is: a filter on its result would otherwise parse each document once more
    if not namespaces:
        docs = docs.withColumn("xml", strip_namespaces(F.col("xml")))
    parsed = docs.select("doc_id", F.explode(F.array(F.from_xml("xml", with_corrupt(schema), PERMISSIVE))).alias("d"))
    return parsed.filter("d is not null and d._corrupt_record is null").select("doc_id", F.struct(*[F.col(f"d.`{f.name}`") for f in schema.fields]).alias("d"))


def attr(path: str, name: str) -> Column:
    """An attribute, trimmed; a missing one is null. Names match in any case under spark.sql.caseSensitive=false."""
    return F.trim(F.col(f"{path}._{name}"))


def element_text(path: str) -> Column:
    return F.trim(F.col(f"{path}._VALUE"))


def explode_path(df: DataFrame, path: str, name: str, keep_empty: bool = False, *carry: str) -> DataFrame:
    """A row for each repeated element, with its place among its siblings in document order."""
    explode = F.posexplode_outer if keep_empty else F.posexplode
    return df.select("doc_id", *carry, explode(path).alias(f"{name}_pos", name))


def explode_child(parents: DataFrame, path: str, name: str, *carry: str) -> DataFrame:
    """Children of parents that a filter has kept, with what is carried from the parent as keys."""
    return parents.select("doc_id", *carry, F.posexplode(path).alias(f"{name}_pos", name))


def attach_fk(child: DataFrame, key: str) -> DataFrame:
    """Children whose parent has a key."""
    return child.filter(F.col(key).isNotNull() & (F.trim(F.col(key).cast("string")) != ""))


def xml_value(c: Column, xpath: str, type: str, well_formed: Column) -> Column:
    """The first value at an XPath as a scalar. The guard comes first, as malformed text would end the whole job."""
    return F.xpath_string(F.when(well_formed, c), F.lit(xpath)).try_cast(type)


def tail_text(c: Column, xpath: str, well_formed: Column) -> Column:
    """The text that follows the first element at an XPath, up to the next element; trimmed, and null where there is none."""
    return F.nullif(F.trim(F.xpath_string(F.when(well_formed, c), F.lit(f"({xpath})[1]/following-sibling::node()[1][self::text()]"))), F.lit(""))


def has_tag(c: Column, tag: str) -> Column:
    return F.contains(c, F.lit(f"<{tag}"))


def attr_rows(df: DataFrame, id: str, columns: dict[str, Column]) -> DataFrame:
    """Attributes as rows (id, name, value), nulls left out: one pass, no join."""
    rows = F.array(*[F.struct(F.lit(n).alias("name"), c.cast("string").alias("value")) for n, c in columns.items()])
    return df.select(id, F.explode(rows).alias("_a")).select(id, "_a.name", "_a.value").filter("value is not null")
