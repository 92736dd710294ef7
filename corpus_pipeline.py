"""Documents to packed training sequences: each stage works on all that the one before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docmill.llm import classifier, common, dedup, near, packing, rules


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold; columns of docs. Labellers and scorer are fitted on docs."""
    w, b = classifier.train(docs)
    name = common.fresh(docs, "_score")
    return classifier.score(docs, w, b, name).filter(f"`{name}` >= {classifier.THRESHOLD}").select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the voting rules keep; columns of docs."""
    inner = docs.select(*[docs[c].alias(f"d{i}") for i, c in enumerate(docs.columns)])
    text = f"d{[c.lower() for c in docs.columns].index('text')}"
    judged = rules.judge(common.stage(rules.measure(inner, text), "rules-docs"))
    return judged.filter("kept").select(*[judged[f"d{i}"].alias(c) for i, c in enumerate(docs.columns)])


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return dedup.deduplicate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-equal texts."""
    return near.keep_one(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("n-gram jaccard join", near_dedup),
    ("best-fit packing", packed_sequences),
]

#: Expectation-maximisation, hashing and tokenizing are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's result staged in the shared folder for the next."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs = common.stage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not None:
            common.discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
