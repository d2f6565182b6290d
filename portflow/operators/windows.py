"""Row-relative logic as window functions.

Windows are always partitioned by the series key (port, lane ...) when one
exists; the marts apply them to monthly aggregates, whose size is bounded
by months x series, never to raw fact rows.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from portflow.operators.joins import DEFAULT_BROADCAST_ROWS, fits
from portflow.session import staged


def _w(partition: Sequence[str]):
    return Window.partitionBy(*partition) if partition else Window.partitionBy()


def share_of_total(df: DataFrame, value: str, out: str, partition: Sequence[str] = (),
                   digits: int | None = 2, zero_total_as_one: bool = False) -> DataFrame:
    """value / sum(value) over the partition * 100.

    ``zero_total_as_one`` divides by 1 when the partition total is 0 (the
    sector-history convention), otherwise such shares are NULL.
    """
    # the total of all rows is a scalar subquery: a window without partitions would put every row into one task
    tot = (F.sum(value).over(_w(partition)) if partition else df.agg(F.sum(value)).scalar()).cast("double")
    if zero_total_as_one:
        tot = F.when(tot == 0, F.lit(1.0)).otherwise(tot)
        share = F.col(value).cast("double") / tot * 100
    else:
        share = F.when(tot != 0, F.col(value).cast("double") / tot * 100)
    return df.withColumn(out, F.round(share, digits) if digits is not None else share)


def series_index(df: DataFrame, order: str, out: str = "idx", partition: Sequence[str] = ()) -> DataFrame:
    """0..n-1 over the rows present (gaps do not consume an index)."""
    return df.withColumn(out, (F.row_number().over(_w(partition).orderBy(order)) - 1).cast("int"))


#: parts that a hot key's rows are dealt into where duplicates are too many to broadcast
SALTS = 32
#: rows from which a key is hot
HOT_ROWS = 100_000


def dup_mark(df: DataFrame, pk: Sequence[str], out: str = "is_dup", max_rows: int = DEFAULT_BROADCAST_ROWS, salts: int = SALTS) -> DataFrame:
    """Flag every member of a duplicated key group (keep=False semantics); NULL keys are equal.

    The duplicated keys come from a map-side combined aggregate and are
    written.  Few of them are broadcast, so no row of ``df`` is shuffled; many
    are merge-joined, each key once and never broadcast, whatever its files'
    size.  Keys of HOT_ROWS rows and more, of which there is one per HOT_ROWS
    rows at most, are then broadcast by themselves, and their rows dealt into
    ``salts`` parts, so a key with a third of the rows makes no long task.
    """
    names = {k: f"_k{i}" for i, k in enumerate(pk)}
    found = staged(df.groupBy(*pk).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*[F.col(k).alias(n) for k, n in names.items()], "_n"), "duplicates")
    dups = found.select(*names.values(), F.lit(True).alias("_dup"))
    same = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(n)) for k, n in names.items()])
    if fits(dups, max_rows):
        x = df.join(F.broadcast(dups), same, "left")
        return x.select(*df.columns, F.coalesce("_dup", F.lit(False)).alias(out))
    hot = found.where(F.col("_n") >= HOT_ROWS)
    if hot.isEmpty():
        x = df.join(dups.hint("merge"), same, "left")
        return x.select(*df.columns, F.coalesce("_dup", F.lit(False)).alias(out))
    hot = hot.select(*[F.col(n).alias(f"_h{n}") for n in names.values()], F.lit(True).alias("_hot"))
    same_hot = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(f"_h{n}")) for k, n in names.items()])
    # the rows of a hot key are marked here; their parts 1 to salts meet no key below
    part = F.when(F.col("_hot"), 1 + F.pmod(F.monotonically_increasing_id(), F.lit(salts))).otherwise(0).cast("int")
    dealt = df.join(F.broadcast(hot), same_hot, "left").withColumn("_salt", part)
    cold = found.where(F.col("_n") < HOT_ROWS).select(*names.values(), F.lit(True).alias("_dup"), F.lit(0).alias("_part"))
    x = dealt.join(cold.hint("merge"), same & (F.col("_salt") == F.col("_part")), "left")
    return x.select(*df.columns, F.coalesce("_hot", "_dup", F.lit(False)).alias(out))


def month_index(date_col) -> Column:
    """Months since year 0: consecutive months differ by 1 (range frames)."""
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    return F.year(d) * 12 + F.month(d) - 1


def trailing_months_sum(df: DataFrame, month_date: str, value: str, out: str, months: int = 12,
                        partition: Sequence[str] = ()) -> DataFrame:
    """Trailing N-month total at every month (calendar months, gap aware)."""
    w = _w(partition).orderBy(month_index(month_date)).rangeBetween(-(months - 1), 0)
    return df.withColumn(out, F.sum(value).over(w))


def argmin_then_recovery(df: DataFrame, order: str, value: str, threshold: Column,
                         partition: Sequence[str] = ()) -> DataFrame:
    """Recovery length in rows.

    Per partition: the first row with the minimum value (earliest on ties),
    then the first later row whose value >= threshold; returns the distance
    in rows (NULL when it never recovers) plus the minimum row's key.
    """
    w = _w(partition).orderBy(order)
    rn = F.row_number().over(w)
    x = df.withColumn("_rn", rn)
    best = F.min(F.struct(F.col(value), F.col("_rn"))).over(_w(partition))
    x = x.withColumn("_min_rn", best["_rn"]).withColumn("_min_v", best[value])
    rec = F.min(F.when((F.col("_rn") > F.col("_min_rn")) &
                       (F.col(value).cast("double") >= threshold), F.col("_rn")))
    # _min_rn / _min_v are constant within a partition: max() just picks them.
    aggs = [F.max("_min_rn").alias("min_row"), F.max("_min_v").alias("min_value"),
            (rec - F.max("_min_rn")).alias("recovery_rows")]
    return x.groupBy(*partition).agg(*aggs) if partition else x.agg(*aggs)
