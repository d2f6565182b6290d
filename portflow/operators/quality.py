"""Declarative data-quality checks: the schema constraints Parquet does not
enforce (PK, FK, CHECK, NOT NULL, length), load reconciliation and
coverage.  Each check is a DataFrame of violation counts, so a job can
assert on it or store it beside the data."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portflow.operators.aggregates import dup_groups


def pk_violations(df: DataFrame, pk: Sequence[str], name: str = "pk") -> DataFrame:
    """Duplicate key groups and the rows inside them (0 / 0 = clean)."""
    g = dup_groups(df, pk)
    return g.agg(F.lit(name).alias("check"), F.count(F.lit(1)).alias("dup_groups"),
                 F.coalesce(F.sum("n"), F.lit(0)).alias("dup_rows"))


def fk_orphans(fact: DataFrame, fk: str, dim: DataFrame, dim_key: str, name: str) -> DataFrame:
    """Fact rows whose foreign key has no dimension row (NULL keys excluded,
    as an FK constraint allows them only if nullable)."""
    o = (fact.select(F.col(fk).alias("_k")).where(F.col("_k").isNotNull())
             .join(dim.select(F.col(dim_key).alias("_k")), "_k", "left_anti"))
    return o.agg(F.lit(name).alias("check"), F.count(F.lit(1)).alias("orphans"))


def check_violations(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """``{name: predicate}`` -> one row per check with its violation count.

    As in SQL CHECK, a predicate that evaluates to NULL passes."""
    aggs = [F.count(F.when(~pred, F.lit(1))).alias(n) for n, pred in checks.items()]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{n}', `{n}`" for n in checks)
    return wide.selectExpr(f"stack({len(checks)}, {stack}) as (check, violations)")


def not_null_and_length(df: DataFrame, not_null: Sequence[str], max_len: Mapping[str, int]) -> DataFrame:
    checks = {f"not_null:{c}": F.col(c).isNotNull() for c in not_null}
    checks.update({f"max_len:{c}": F.length(F.col(c)) <= n for c, n in max_len.items()})
    return check_violations(df, checks)


def count_bands(counts: DataFrame, bands: DataFrame) -> DataFrame:
    """counts(check, n) joined with bands(check, low, high) -> ok flag."""
    return (counts.join(bands, "check", "inner")
                  .select("check", "n", "low", "high", F.col("n").between(F.col("low"), F.col("high")).alias("ok")))


def source_overlap(df: DataFrame, pk: Sequence[str], source: str) -> DataFrame:
    """Keys present under more than one source (must be 0 before appending)."""
    # "more than one distinct source" as min <> max: one partial+final
    # aggregate, no distinct expansion of the fact rows
    k = df.groupBy(*pk).agg((F.min(source) != F.max(source)).alias("_multi")).where("_multi")
    return k.agg(F.count(F.lit(1)).alias("overlapping_keys"))


def month_gaps(present: DataFrame, key: str, spine: DataFrame, spine_key: str) -> DataFrame:
    """Expected months missing from the data, and months present but not
    expected; one row per period with its status."""
    p = present.select(F.col(key).alias("period")).distinct()
    s = spine.select(F.col(spine_key).alias("period"))
    missing = s.join(p, "period", "left_anti").withColumn("status", F.lit("missing"))
    extra = p.join(s, "period", "left_anti").withColumn("status", F.lit("unexpected"))
    return missing.unionByName(extra)


def coverage_pct(expected: DataFrame, actual: DataFrame, key: str, exp_col: str, act_col: str,
                 digits: int = 1) -> DataFrame:
    """Actual / expected per key in percent; expected 0 -> 0."""
    j = expected.join(actual, key, "left").fillna({act_col: 0})
    e = F.col(exp_col).cast("double")
    return j.select(key, exp_col, act_col,
                    F.when(e == 0, F.lit(0.0)).otherwise(F.round(F.col(act_col).cast("double") * 100 / e, digits))
                     .alias("coverage_pct"))
