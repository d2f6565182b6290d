"""Sinks: idempotent table writes and JSON documents.

* ``write_full_refresh`` — overwrite a table (the TRUNCATE + bulk load of a
  relational store), partitioned for pruning.
* ``write_source_partitions`` — replace only the partitions present in the
  frame (dynamic partition overwrite), so one source or one month can be
  reloaded without touching the others; re-running a load changes nothing.
* ``write_document`` — one JSON document per mart with NULLs written out.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


MAX_RECORDS_PER_FILE = 5_000_000


def write_full_refresh(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                       fmt: str = "parquet") -> None:
    w = df
    if partition_by:
        # cluster rows of a partition value into few files; a large value is split over tasks and files
        w = df.hint("rebalance", *partition_by)
    writer = w.write.mode("overwrite").format(fmt).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_source_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Dynamic partition overwrite: only the partitions in ``df`` are replaced."""
    spark = df.sparkSession
    prev = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        (df.hint("rebalance", *partition_by).write.mode("overwrite")
           .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).partitionBy(*partition_by).parquet(path))
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)


def with_audit(df: DataFrame, col: str = "loaded_at") -> DataFrame:
    return df.withColumn(col, F.current_timestamp())


def to_document(df: DataFrame, name: str = "data") -> DataFrame:
    """All rows of a (small, aggregated) mart as one JSON document.

    NULL fields are written as ``null`` (not dropped), decimals as numbers,
    dates as ISO text.  Only for mart outputs, which are bounded by months x
    ports; never for fact rows."""
    # sorted, so a retried task or a re-run writes byte-identical documents
    rows = F.array_sort(F.collect_list(F.struct(*df.columns)))
    return df.agg(F.to_json(F.struct(rows.alias(name)), {"ignoreNullFields": "false"}).alias("value"))


def write_document(df: DataFrame, path: str, name: str = "data") -> None:
    to_document(df, name).coalesce(1).write.mode("overwrite").text(path)
