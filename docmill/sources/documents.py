"""Sources of (id, xml) documents, and the ways to slice, resume and stage them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .staging import dealt

#: Bytes 0x80 to 0x9F, as ISO-8859-1 reads them: those that Windows-1252 leaves undefined, the other 27, and what it makes of these.
UNDEFINED = "\x81\x8d\x8f\x90\x9d"
C1 = "".join(chr(b) for b in range(0x80, 0xA0) if chr(b) not in UNDEFINED)
CP1252 = C1.encode("latin-1").decode("cp1252")


def read_documents(spark: SparkSession, path: str, id: str, xml: str) -> DataFrame:
    """Documents of a table, without those whose xml is null or blank."""
    return present(spark.read.parquet(path).select(F.col(id).alias("doc_id"), F.col(xml).alias("xml")))


def read_table(spark: SparkSession, name: str, id: str, xml: str) -> DataFrame:
    """Documents of a table of the catalog; a filter on doc_id reaches its scan."""
    return present(spark.table(name).select(F.col(id).alias("doc_id"), F.col(xml).alias("xml")))


def read_jdbc(
    spark: SparkSession, url: str, table: str, id: str, xml: str, partitions: int = 8, bounds: tuple[int, int] | None = None, even: bool = False, properties: dict[str, str] | None = None,
    quote: str = '"',
) -> DataFrame:
    """Documents of a database table, read by `partitions` queries of an id range each; filters on doc_id go to the database.

    Without `bounds` the database is asked for the least and largest id. Ranges are equally wide; with `even` they hold about
    as many ids each, which costs a scan of the ids alone, and is right where ids lie in clusters. Ids beyond the bounds are
    read, too: the first and the last range are open. Rows without an id, whose document could not be named, are not.
    `quote` is what the database puts around names.
    """
    name = f"{quote}{id}{quote}"
    properties = {"fetchsize": "1000", **(properties or {})}
    if bounds is None:
        ask = spark.read.format("jdbc").options(url=url, query=f"SELECT MIN({name}) AS lo, MAX({name}) AS hi FROM {table}", **properties)
        bounds = tuple(ask.load().first())
    lo, hi = (int(b) for b in bounds) if bounds[0] is not None else (0, 1)
    hi = max(hi, lo + 1)
    wide = spark.read.jdbc(url, table, column=id, lowerBound=lo, upperBound=hi, numPartitions=partitions, properties=properties)
    if even and partitions > 1:
        points = [i / partitions for i in range(1, partitions)]
        cuts = sorted(set(wide.filter(F.col(id).isNotNull()).approxQuantile(id, points, 0.1 / partitions)))
        cuts = [int(c) for c in cuts]
        ranges = [f"{name} < {cuts[0]}", *[f"{name} >= {a} AND {name} < {b}" for a, b in zip(cuts[:-1], cuts[1:], strict=True)], f"{name} >= {cuts[-1]}"] if cuts else ["1 = 1"]
        wide = spark.read.jdbc(url, table, predicates=ranges, properties=properties)
    return present(wide.filter(F.col(id).isNotNull()).select(F.col(id).cast("bigint").alias("doc_id"), F.col(xml).alias("xml")))


def present(docs: DataFrame) -> DataFrame:
    return docs.filter(F.trim("xml") != "")


def read_xml_dir(spark: SparkSession, glob: str, id_pattern: str = r'<Request[^>]*\bID="([0-9]+)"', root: str | None = None) -> DataFrame:
    """XML files as documents, a file each; the id is taken from the request. With the name of the root element, a file
    may hold several documents, one after the other. A file may have up to 2 GB, unpacked if its name says that it is packed (.gz)."""
    # a whole file as one value of text holds its bytes as they are
    files = spark.read.text(glob, wholetext=True).select(decode_text(F.col("value").cast("binary")).alias("xml"), F.col("_metadata.file_path").alias("path"))
    if root:
        files = files.select(F.explode(F.split("xml", rf"(?<=</{root}>)\s*(?=<)")).alias("xml"), "path")
    return files.select(F.expr("try_cast(regexp_extract(xml, '" + id_pattern.replace("\\", "\\\\") + "', 1) as bigint)").alias("doc_id"), "xml", "path")


def decode_text(data: Column) -> Column:
    """Bytes as text: UTF-8, else Windows-1252, where the five bytes that it leaves undefined become U+FFFD.

    Spark refuses the charset without spark.sql.legacy.javaCharsets, so ISO-8859-1 is decoded and its C1 controls are replaced.
    """
    text = F.translate(F.decode(data, "ISO-8859-1"), C1 + UNDEFINED, CP1252 + "\ufffd" * len(UNDEFINED))
    return F.when(F.is_valid_utf8(data.cast("string")), data.cast("string")).otherwise(text)


def encode_cp1252(text: Column) -> Column:
    """Text as Windows-1252 bytes; null if it has a character that the charset lacks."""
    known = ~text.rlike(f"[^\\x00-\\x7F\\xA0-\\xFF{CP1252}]")
    return F.when(known, F.encode(F.translate(text, CP1252, C1), "ISO-8859-1"))


def slice_range(df: DataFrame, lo: int | None, hi: int | None, id: str = "doc_id") -> DataFrame:
    """Ids from lo to hi, each of which may be open; a filter that reaches the scan."""
    for bound, test in ((lo, F.col(id) >= F.lit(lo)), (hi, F.col(id) <= F.lit(hi))):
        df = df if bound is None else df.filter(test)
    return df


def shard(df: DataFrame, n: int, i: int, id: str = "doc_id") -> DataFrame:
    return df.filter(F.pmod(F.col(id), F.lit(n)) == i)


def next_page(df: DataFrame, after: int | None, n: int, id: str = "doc_id") -> DataFrame:
    """The next n ids beyond a cursor, in order; the next cursor is the page's largest id."""
    return (df if after is None else df.filter(F.col(id) > after)).orderBy(id).limit(n)


def semi(df: DataFrame, applications: DataFrame, id: str) -> DataFrame:
    return df.join(applications.select(id), id, "left_semi")


def unprocessed(df: DataFrame, log: DataFrame, id: str = "doc_id", retry_failed: bool = False) -> DataFrame:
    """Documents without a log row, of whatever status; with retry_failed, failures count as unprocessed."""
    seen = log.filter("status = 'success'") if retry_failed else log
    return df.join(dealt(seen.select(id)), id, "left_anti")


def first_by_id(df: DataFrame, id: str, *order: str | Column) -> DataFrame:
    """Of rows with one id, the first."""
    return df.withColumn("_nth", F.row_number().over(Window.partitionBy(id).orderBy(*order))).filter("_nth = 1").drop("_nth")


def reduce_documents(docs: DataFrame, schema: T.StructType, row_tag: str, needed: list[str]) -> DataFrame:
    """Stage smaller documents: only what the schema names is kept; those that lack a needed path go."""
    kept = docs.select("doc_id", F.from_xml("xml", schema, {"mode": "PERMISSIVE"}).alias("d"))
    for path in needed:
        kept = kept.filter(F.col(f"d.{path}").isNotNull())
    return kept.select("doc_id", F.to_xml("d", {"rowTag": row_tag}).alias("xml"))


def read_metrics(spark: SparkSession, path: str, glob: str = "*.json", schema: T.StructType | None = None, lines: bool = False) -> DataFrame:
    """Run metrics, a nested JSON file for each run (or, with lines, a row for each line); the glob picks sessions or dates."""
    reader = spark.read.option("multiLine", not lines).option("pathGlobFilter", glob)
    return (reader.schema(schema) if schema else reader).json(path)


def read_runs(spark: SparkSession, path: str, schema: T.StructType, glob: str = "*") -> DataFrame:
    """Nested run metrics in files that hold one or more JSON objects of many lines each, with blank lines between them.

    The glob picks sessions or dates. Objects that can't be read are left out.
    """
    text = spark.read.option("wholetext", False).option("lineSep", "\n\n").option("pathGlobFilter", glob).text(path)
    return text.filter(F.trim("value") != "").select(F.from_json("value", schema).alias("_r")).filter("_r is not null").select("_r.*")
