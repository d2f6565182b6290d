"""Conforming raw feed rows into fact rows.

All steps are column expressions over one projection; a load is a chain
``read -> filter -> map codes -> reject split -> nullify -> dedup -> write``
with no driver round trip.  Rejected rows are kept (quarantine) with the
reasons that removed them, so accepted + rejected = input always holds.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def filter_eq(df: DataFrame, col: str, value) -> DataFrame:
    return df.where(F.col(col) == F.lit(value))


def exclude_value(df: DataFrame, col: str, value) -> DataFrame:
    """Drop rows equal to ``value`` but KEEP rows where the column is NULL
    (pandas ``!=`` semantics; SQL ``<>`` would drop the NULLs too)."""
    return df.where(~F.col(col).eqNullSafe(F.lit(value)))


def tag(df: DataFrame, col: str, value) -> DataFrame:
    return df.withColumn(col, F.lit(value))


def nullify_when(value, pred: Column) -> Column:
    """``value`` unless ``pred`` holds, then NULL (e.g. zero weight on exports)."""
    return F.when(pred, F.lit(None)).otherwise(_col(value))


def with_reject_reasons(df: DataFrame, required: Mapping[str, Column], out: str = "reject_reasons") -> DataFrame:
    """Add an array of the reasons a row fails: ``{reason: column that must
    not be NULL}``.  Empty array = accepted."""
    arr = F.array(*[F.when(_col(c).isNull(), F.lit(reason)) for reason, c in required.items()])
    return df.withColumn(out, F.filter(arr, lambda x: x.isNotNull()))


def reject_split(df: DataFrame, required: Mapping[str, Column],
                 out: str = "reject_reasons") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected); both lazy, from one projection."""
    x = with_reject_reasons(df, required, out)
    return x.where(F.size(out) == 0).drop(out), x.where(F.size(out) > 0)


def reject_counts(rejected: DataFrame, reasons: str = "reject_reasons") -> DataFrame:
    """Rows per reject reason (a row with two reasons counts in both)."""
    return (rejected.select(F.explode(reasons).alias("reason"))
                    .groupBy("reason").agg(F.count(F.lit(1)).alias("n")))


def top_offending(rejected: DataFrame, reason: str, value_col: str, top: int = 5,
                  reasons: str = "reject_reasons") -> DataFrame:
    """Most frequent raw values behind one reject reason."""
    return (rejected.where(F.array_contains(reasons, reason))
                    .groupBy(value_col).agg(F.count(F.lit(1)).alias("n"))
                    .orderBy(F.desc("n"), F.asc_nulls_first(value_col)).limit(top))


def unmapped_codes(df: DataFrame, col: str, known: DataFrame, known_col: str) -> DataFrame:
    """Distinct observed codes with no entry in the code book (non-NULL)."""
    obs = df.select(F.col(col).alias("code")).where(F.col("code").isNotNull()).distinct()
    return obs.join(known.select(F.col(known_col).alias("code")), "code", "left_anti")


def try_long(c) -> Column:
    """Tolerant cast for optional measures: bad text -> NULL."""
    return _col(c).try_cast("long")


def strict_long(c) -> Column:
    """Fail-hard cast for required measures: bad text raises (ANSI)."""
    return _col(c).cast("long")


def round_ingest(c, digits: int = 2, dtype: str = "decimal(6,2)") -> Column:
    """Round half-even on ingest, then store as a fixed decimal."""
    return F.bround(_col(c).cast("double"), digits).cast(dtype)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def first_non_null(cols: Sequence[str]) -> Column:
    return F.coalesce(*[F.col(c) for c in cols])
