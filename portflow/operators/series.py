"""Series shaping: month spines, gap fill, zero-filled grids, heatmaps, maps.

Spines and grids are generated with ``sequence`` + ``explode`` from a
one-row aggregate (no driver round trip, no join to build them); the data is
then attached with an equi-join on the series key.
"""

from __future__ import annotations

from typing import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from portflow.operators.joins import bounded_broadcast
from portflow.session import staged


def month_spine(bounds: DataFrame, start: str, end: str, out: str = "month_date") -> DataFrame:
    """One row per month from ``start`` to ``end`` (date columns of a one-row
    frame), both inclusive."""
    return bounds.select(F.explode(F.sequence(F.col(start), F.col(end), F.expr("interval 1 month"))).alias(out))


def gapfill_months(series: DataFrame, month_col: str, values: list[str], start: str,
                   end: str | None = None, out: str = "month_date") -> DataFrame:
    """Month spine from ``start`` to the last month of the series (or
    ``end``), with the series' values or NULL.

    One pass: the (monthly, hence calendar-bounded) series is folded into a
    single row holding a month -> values map and its last month; the spine is
    exploded from that row and looked up in the map.  The series plan is
    evaluated once and no join is planned."""
    # a row without a month belongs to no month of the spine
    pts = F.map_from_entries(F.collect_list(F.when(F.col(month_col).isNotNull(), F.struct(F.col(month_col), F.struct(*[F.col(v) for v in values])))))
    last = F.lit(end).cast("date") if end else F.max(month_col)
    one = series.agg(pts.alias("_m"), last.alias("_e"))
    x = one.select("_m", F.explode(F.sequence(F.lit(start).cast("date"), F.col("_e"),
                                              F.expr("interval 1 month"))).alias(out))
    return x.select(out, *[F.col("_m")[F.col(out)][v].alias(v) for v in values])


def day_spine(bounds: DataFrame, start: str, end: str, out: str = "full_date") -> DataFrame:
    return bounds.select(F.explode(F.sequence(F.col(start), F.col(end), F.expr("interval 1 day"))).alias(out))


def gapfill(spine: DataFrame, series: DataFrame, key: str) -> DataFrame:
    """Complete spine LEFT JOIN the series: missing periods keep NULL measures
    (never interpolated, never 0)."""
    return spine.join(series, key, "left")


#: column values that travel together when a grid is built
DOMAIN_CHUNK = 1000


def domain_chunks(values: DataFrame, size: int = DOMAIN_CHUNK) -> DataFrame:
    """(chunk, values): the distinct values of a one-column frame in arrays of at most ``size``, written."""
    (name,) = values.columns
    schema = T.StructType([T.StructField("chunk", T.StringType()), T.StructField("values", T.ArrayType(values.schema[name].dataType))])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            column = batch.column(0)
            for k in range(0, len(column), size):
                piece = column.slice(k, size)
                array = pa.ListArray.from_arrays(pa.array([0, len(piece)], pa.int32()), piece)
                yield pa.RecordBatch.from_arrays([pa.array([f"{part}-{n}"]), array.cast(arrow.field("values").type)], schema=arrow)
                n += 1

    return staged(values.distinct().mapInArrow(run, schema), "domain")


def grid_zero_fill(df: DataFrame, row: str, col: str, value: str, out: str | None = None) -> DataFrame:
    """Every (row, col) pair of the values present, missing cells -> 0; one cell at most per pair in ``df``.

    The cells and the distinct columns are written; columns are packed in
    chunks.  Each row key gets every chunk by an equi-join (the chunks are
    broadcast if they are few) and is exploded where it lies, and the cells
    are joined to the grid by their pair.  No step gathers the columns or the
    rows in one task.
    """
    dtype = df.schema[value].dataType
    cells = staged(df.select(row, col, F.col(value).alias("_v")), "cells")
    chunks = domain_chunks(cells.select(col))
    names = chunks.agg(F.collect_list("chunk")).scalar()  # one name per DOMAIN_CHUNK columns
    rows = cells.select(row).distinct().withColumn("chunk", F.explode(names))
    grid = rows.join(bounded_broadcast(chunks, DOMAIN_CHUNK), "chunk").select(row, F.explode("values").alias(col))
    cells = cells.select(F.col(row).alias("_r"), F.col(col).alias("_c"), "_v")
    same = F.col(row).eqNullSafe(F.col("_r")) & F.col(col).eqNullSafe(F.col("_c"))  # NULL is a row or column of its own
    return grid.join(cells, same, "left").select(row, col, F.coalesce("_v", F.lit(0)).cast(dtype).alias(out or value))


def heatmap_long(df: DataFrame, keys: Sequence[str], day: str, value_expr: Column, n_name: str = "n") -> DataFrame:
    """ISO week x ISO weekday cells, all years pooled: one row per cell."""
    d = F.col(day)
    return (df.groupBy(*keys, F.weekofyear(d).alias("iso_week"), (F.weekday(d) + 1).alias("iso_dow"))
              .agg(value_expr, F.count(F.lit(1)).alias(n_name)))


def heatmap_matrix(cells: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Long cells -> one row per key and week with a 7-slot array Mon..Sun,
    NULL where the weekday has no data."""
    slots = [F.max(F.when(F.col("iso_dow") == i, F.col(value))).alias(f"d{i}") for i in range(1, 8)]
    return (cells.groupBy(*keys, "iso_week").agg(*slots)
                 .select(*keys, "iso_week", F.array(*[F.col(f"d{i}") for i in range(1, 8)]).alias("week_values")))


def series_map(df: DataFrame, keys: Sequence[str], order: str, fields: Sequence[str],
               sep: str = "|", out: str = "series") -> DataFrame:
    """One row per series key: ``concat_ws(sep, keys)`` and its points as an
    ordered ``array<struct>``.  The array holds one series (months of one
    port x lane), bounded by the series length."""
    pts = F.array_sort(F.collect_list(F.struct(F.col(order), *[F.col(f) for f in fields])))
    return (df.groupBy(*keys).agg(pts.alias(out))
              .select(F.concat_ws(sep, *[F.col(k).cast("string") for k in keys]).alias("series_key"), out))


def combos_with_default(df: DataFrame, a: str, b: str, default_a, default_b) -> DataFrame:
    """Distinct (a, b) combos plus the default view: the preferred pair when
    present, else the smallest pair.  The window runs over the distinct
    combos only (ports x lanes), never over fact rows."""
    combos = df.select(a, b).distinct()
    w = Window.partitionBy()
    is_pref = (F.col(a) == F.lit(default_a)) & (F.col(b) == F.lit(default_b))
    d = F.coalesce(F.max(F.when(is_pref, F.struct(a, b))).over(w), F.min(F.struct(a, b)).over(w))
    return combos.select(a, b, d[a].alias("default_" + a), d[b].alias("default_" + b))
