"""Aggregations.

Every aggregate here is planned by Catalyst as partial (map-side) + final
hash aggregation, so a hot key is pre-combined inside each task before the
shuffle; no operator collects a group's rows or sorts a raw group in one
task (exact percentiles work on per-group value counts).
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from portflow.functions import dates, metrics


def sum_by(df: DataFrame, keys: Sequence[str], value: str, out: str,
           dtype: str = "decimal(38,2)") -> DataFrame:
    """Group sum; SUM over only NULLs stays NULL (timelines need the NULL)."""
    return df.groupBy(*keys).agg(F.sum(value).cast(dtype).alias(out))


def global_sum_or_zero(df: DataFrame, value: str, out: str, dtype: str = "decimal(38,2)") -> DataFrame:
    """One row; 0 when no row qualifies (scalar KPI convention)."""
    return df.agg(F.coalesce(F.sum(value), F.lit(0)).cast(dtype).alias(out))


def coverage(df: DataFrame, col: str, prefix: str = "") -> DataFrame:
    return df.agg(F.min(col).alias(f"{prefix}min"), F.max(col).alias(f"{prefix}max"))


def year_months(df: DataFrame, date_id: str = "date_id") -> DataFrame:
    """Per year: distinct months present and whether all 12 are."""
    return (df.groupBy(dates.key_year(date_id).alias("year"))
              .agg(F.countDistinct(date_id).alias("months"))
              .withColumn("complete", F.col("months") == 12))


def last_complete_year(df: DataFrame, date_id: str = "date_id", out: str = "year") -> DataFrame:
    """One row: the latest year with 12 distinct months (NULL if none).

    Counted over the rows given, so a gap year is simply skipped."""
    return (year_months(df, date_id).where("complete")
            .agg(F.max("year").cast("int").alias(out)))


def dedup_sum(df: DataFrame, pk: Sequence[str], measures: Sequence[str],
              keep: Mapping[str, Column] | None = None) -> DataFrame:
    """Collapse duplicate primary keys by summing the measures.

    NULL-preserving: a group whose measure is all NULL keeps NULL (SQL SUM);
    NULL key values form their own group, as the load requires.
    """
    aggs = [F.sum(m).alias(m) for m in measures]
    aggs += [c.alias(n) for n, c in (keep or {}).items()]
    return df.groupBy(*pk).agg(*aggs)


def dedup_mean(df: DataFrame, pk: Sequence[str], measure: str, out: str | None = None) -> DataFrame:
    """Collapse duplicates by the mean, rounded half up to 2 decimals (exact)."""
    return (df.groupBy(*pk)
              .agg(F.sum(metrics.cents(measure)).alias("_c"), F.count(measure).alias("_n"))
              .select(*pk, metrics.mean_half_up("_c", "_n").alias(out or measure)))


def dup_groups(df: DataFrame, pk: Sequence[str], top: int | None = None) -> DataFrame:
    """Groups of the key that occur more than once, largest first."""
    g = df.groupBy(*pk).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if top:
        return g.orderBy(F.desc("n"), *[F.asc_nulls_first(k) for k in pk]).limit(top)
    return g


def value_counts(df: DataFrame, col: str, top: int | None = None) -> DataFrame:
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    if top:
        return g.orderBy(F.desc("n"), F.asc_nulls_first(col)).limit(top)
    return g


def fused(df: DataFrame, specs: Mapping[str, tuple[Column, Column]],
          dtype: str | None = None, zero_if_empty: bool = True) -> DataFrame:
    """Many scalar sums in one pass: ``{name: (predicate, value)}``.

    Replaces one scan per scalar query with one conditional aggregate.
    """
    out = []
    for name, (pred, val) in specs.items():
        s = F.sum(F.when(pred, val))
        if zero_if_empty:
            s = F.coalesce(s, F.lit(0))
        out.append((s.cast(dtype) if dtype else s).alias(name))
    return df.agg(*out)


def regression(df: DataFrame, x: str, y: str, group: Sequence[str] = ()) -> DataFrame:
    """Simple least squares of y on x: slope, intercept, R^2, n.

    Guards: fewer than 2 points -> NULL; no x variance -> slope 0;
    constant y -> R^2 = 0 (the built-in would report 1).
    """
    n = F.count(y)
    var_x = F.var_pop(x)
    var_y = F.var_pop(y)
    slope = F.when(n < 2, None).when(var_x == 0, F.lit(0.0)).otherwise(F.regr_slope(y, x))
    icpt = F.when(n < 2, None).when(var_x == 0, F.avg(y)).otherwise(F.regr_intercept(y, x))
    r2 = F.when(n < 2, None).when((var_y == 0) | (var_x == 0), F.lit(0.0)).otherwise(F.regr_r2(y, x))
    aggs = [slope.alias("slope"), icpt.alias("intercept"), r2.alias("r_squared"), n.alias("n")]
    return df.groupBy(*group).agg(*aggs) if group else df.agg(*aggs)


def percentiles(df: DataFrame, keys: Sequence[str], value: str, qs: Sequence[float],
                names: Sequence[str], exact: bool = True) -> DataFrame:
    """Continuous percentiles per group.

    ``exact`` -> ``percentile_exact`` (value counts, skew-proof, decimal);
    ``exact=False`` -> ``percentile_approx`` (bounded-memory sketch) for
    value domains too large to enumerate.
    """
    if exact:
        return percentile_exact(df, keys, value, qs, names, digits=9)
    v = F.col(value).cast("double")
    return df.groupBy(*keys).agg(*[F.percentile_approx(v, q, 10000).alias(n) for q, n in zip(qs, names)])


def percentile_exact(df: DataFrame, keys: Sequence[str], value: str, qs: Sequence[float],
                     names: Sequence[str], digits: int = 2) -> DataFrame:
    """PERCENTILE_CONT computed exactly in DECIMAL, rounded half up.

    Skew-proof: rows are first reduced to (group, value, count) — a map-side
    combined aggregate, so a group holding a third of the data costs no more
    than any other — and the order statistics around ``q * (n - 1)`` are found
    with a cumulative count over the *distinct values* of each group (bounded
    by the value domain, e.g. 1e6 for decimal(6,2) minutes).  Values keep their
    own type: decimals are interpolated in decimal arithmetic, so the result does
    not depend on floating-point evaluation order; other numbers as doubles.
    """
    exact = isinstance(df.schema[value].dataType, T.DecimalType)
    v = F.col(value) if exact else F.col(value).cast("double")
    vc = df.where(F.col(value).isNotNull()).groupBy(*keys, v.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    grp = Window.partitionBy(*keys) if keys else Window.partitionBy()
    cum = F.sum("_c").over(grp.orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    x = vc.select(*keys, "_v", (cum - 1).alias("_last"), F.sum("_c").over(grp).alias("_n"))
    aggs = []
    for q, name in zip(qs, names):
        pos = F.lit(q).cast("decimal(10,6)") * (F.col("_n") - 1)       # 0-based fractional rank
        lo = F.floor(pos)
        lo_v = F.min(F.when(F.col("_last") >= lo, F.col("_v")))          # value holding rank lo
        hi_v = F.min(F.when(F.col("_last") >= lo + 1, F.col("_v")))      # ... and rank lo + 1
        fr = F.max(pos - lo).cast("decimal(10,6)" if exact else "double")
        aggs.append(F.round(lo_v + (F.coalesce(hi_v, lo_v) - lo_v) * fr, digits).cast("double").alias(name))
    return x.groupBy(*keys).agg(*aggs) if keys else x.agg(*aggs)


def first_last(df: DataFrame, keys: Sequence[str], date_col: str, measure: str) -> DataFrame:
    """First/last observation date, rows, distinct dates, per group."""
    return df.groupBy(*keys).agg(
        F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date"),
        F.count(measure).alias("n_obs"), F.countDistinct(date_col).alias("n_dates"))
