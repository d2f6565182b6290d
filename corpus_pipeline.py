"""From raw documents to packed sequences: five stages, each one of the operators in portflow.llm.

Each stage gets what its predecessor kept, read again from Parquet, and its decisions take effect in what it returns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portflow.llm.common import table, written
from portflow.llm.decontamination import drop_contaminated
from portflow.llm.line_dedup import drop_boilerplate
from portflow.llm.packing import pack
from portflow.llm.quality_rules import keep_quality
from portflow.llm.simhash import keep_one


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep (operator 1)."""
    return keep_quality(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents without their hosts' boilerplate lines (operator 8); n_chars follows the text."""
    cleaned = drop_boilerplate(docs)
    if "n_chars" not in docs.columns:
        return cleaned
    n_chars = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType)
    return cleaned.withColumn("n_chars", n_chars)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (operator 9)."""
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark (operator 7)."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: the pieces of the documents that are left (operator 2)."""
    return pack(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontaminate),
    ("packing", packing),
]

#: none: SQL has no tokenizer; tests hold each stage against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
