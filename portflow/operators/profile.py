"""Column profiling in one pass per question (no per-column jobs)."""

from __future__ import annotations

from typing import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from portflow.operators.joins import bounded_broadcast
from portflow.session import staged


def _stack(wide: DataFrame, names: Sequence[str], fields: Sequence[str], key: str = "column") -> DataFrame:
    """Turn ``{name}__{field}`` columns of a one-row frame into one row per name."""
    parts = []
    for n in names:
        parts.append(f"'{n}'")
        parts += [f"`{n}__{f}`" for f in fields]
    cols = ", ".join([key] + list(fields))
    return wide.selectExpr(f"stack({len(names)}, {', '.join(parts)}) as ({cols})")


def profile_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column: type, rows, NULLs, NULL %, a stable example (the minimum
    as text) — one aggregate over all columns."""
    cols = list(cols or df.columns)
    types = dict(df.dtypes)
    aggs = []
    for c in cols:
        v = F.col(c)
        aggs += [F.count(F.lit(1)).alias(f"{c}__rows"),
                 F.count_if(v.isNull()).alias(f"{c}__nulls"),
                 F.min(v.cast("string")).alias(f"{c}__example")]
    wide = df.agg(*aggs)
    long = _stack(wide, cols, ["rows", "nulls", "example"])
    tmap = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(types[c]))])
    return long.select("column", tmap[F.col("column")].alias("type"), "rows", "nulls",
                       F.round(F.when(F.col("rows") > 0, F.col("nulls") * 100.0 / F.col("rows")), 2).alias("null_pct"),
                       "example")


#: distinct values, and their bytes, that a task holds before it passes its counts on; Spark's partial aggregate behind it merges further
HELD_VALUES = 20_000
HELD_BYTES = 4 << 20
#: rows of a batch that a task passes on
PASSED_ROWS = 10_000


def value_counts_long(df: DataFrame, cols: Sequence[str], value: T.DataType) -> DataFrame:
    """(column, value, n) of several columns in one scan; values are cast to ``value``, NULLs left out.

    Tasks count whole Arrow batches column by column and merge the counts
    before anything is shuffled, so no input row is ever expanded into one
    row per column.  What a task holds is bounded by HELD_VALUES and
    HELD_BYTES (and a batch), whatever the number of rows it reads.
    """
    schema = T.StructType([T.StructField("column", T.IntegerType()), T.StructField("value", value), T.StructField("n", T.LongType())])
    arrow = to_arrow_schema(schema)

    def merged(parts: list[pa.Table]) -> pa.Table:
        out = pa.concat_tables(parts).group_by(["column", "value"]).aggregate([("n", "sum")])
        return pa.table({"column": out["column"], "value": out["value"], "n": out["n_sum"]}, schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, size = [], 0, 0
        for batch in batches:
            for k in range(len(cols)):
                counts = pc.value_counts(batch.column(k).drop_null())
                held.append(pa.table({"column": pa.repeat(pa.scalar(k, pa.int32()), len(counts)), "value": counts.field(0), "n": counts.field(1)}, schema=arrow))
                rows += len(counts)
                size += held[-1].nbytes
            if rows > 4 * HELD_VALUES or size > 4 * HELD_BYTES:
                held = [merged(held)]
                rows, size = held[0].num_rows, held[0].nbytes
                if rows > HELD_VALUES or size > HELD_BYTES:
                    yield from held[0].to_batches(PASSED_ROWS)
                    held, rows, size = [], 0, 0
        if held:
            yield from merged(held).to_batches(PASSED_ROWS)

    narrow = df.select(*[F.col(c).cast(value).alias(f"c{k}") for k, c in enumerate(cols)])
    names = F.array(*[F.lit(c) for c in cols])
    counts = narrow.mapInArrow(run, schema).groupBy("column", "value").agg(F.sum("n").alias("n"))
    return counts.select(names[F.col("column")].alias("column"), "value", "n")


def profile_distinct(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Distinct values per column (exact, or HyperLogLog++ when ``approx``)."""
    if approx:
        return _stack(df.agg(*[F.approx_count_distinct(c).alias(f"{c}__n_distinct") for c in cols]), cols, ["n_distinct"])
    # equal values have equal texts; zero has one text whatever its sign
    kinds = dict(df.dtypes)
    same = df.select(*[(F.col(c) + F.lit(0).cast(kinds[c]) if kinds[c] in ("double", "float") else F.col(c)).alias(c) for c in cols])
    n = value_counts_long(same, cols, T.StringType()).groupBy("column").agg(F.count("*").alias("n"))
    every = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    return every.join(F.broadcast(n), "column", "left").select("column", F.coalesce("n", F.lit(0)).alias("n_distinct"))


def ranked_counts(counts: DataFrame) -> DataFrame:
    """(column, value, n) -> the same with ``last``, the 0-based rank of the value's last row, and ``total``, the column's rows.

    Counts are range-partitioned by column and value and summed up partition
    by partition; what lies before a partition comes from the partitions'
    totals.  A column is never gathered in one task.
    """
    schema = T.StructType([*counts.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("upto", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, column, upto = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            sums = []
            for name, n in zip(batch.column("column").to_pylist(), batch.column("n").to_pylist()):
                upto = n + (upto if name == column else 0)
                column = name
                sums.append(upto)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.repeat(pa.scalar(part, pa.int32()), batch.num_rows), pa.array(sums, pa.int64())], schema=to_arrow_schema(schema))

    ordered = counts.repartitionByRange("column", "value").sortWithinPartitions("column", "value")
    summed = staged(ordered.mapInArrow(run, schema), "ranked")
    column = Window.partitionBy("column")
    parts = summed.groupBy("column", "part").agg(F.max("upto").alias("here"))  # a few rows per partition
    parts = parts.select("column", "part", (F.sum("here").over(column.orderBy("part")) - F.col("here")).alias("before"), F.sum("here").over(column).alias("total"))
    return summed.join(bounded_broadcast(parts), ["column", "part"]).select("column", "value", "n", (F.col("before") + F.col("upto") - 1).alias("last"), "total")


def quantiles(counts: DataFrame, qs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Continuous quantiles per column of (column, value, n): the values around each rank, interpolated."""
    x = ranked_counts(counts)
    aggs = []
    for q, name in zip(qs, names):
        at = F.lit(q).cast("decimal(10,6)") * (F.col("total") - 1)
        low, high = (F.min(F.when(F.col("last") >= F.floor(at) + k, F.col("value"))) for k in (0, 1))
        share = F.max(at - F.floor(at)).cast("double")
        aggs.append((low + (F.coalesce(high, low) - low) * share).alias(name))
    return x.groupBy("column").agg(*aggs)


def describe(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """count, mean, std (sample), min, quartiles, max per column; of a text column, of its lengths.

    Moments come from one aggregate; exact quartiles from value counts of all
    columns (one scan) and a rank lookup, with ``exact=False`` from sketches.
    """
    kinds = dict(df.dtypes)
    numbers = df.select(*[(F.length(c) if kinds[c].startswith(("string", "char", "varchar")) else F.col(c)).cast("double").alias(c) for c in cols])
    aggs = []
    for c in cols:
        v = F.col(c)
        aggs += [F.count(v).alias(f"{c}__count"), F.avg(v).alias(f"{c}__mean"),
                 F.stddev_samp(v).alias(f"{c}__std"), F.min(v).alias(f"{c}__min"), F.max(v).alias(f"{c}__max")]
        if not exact:
            aggs += [F.percentile_approx(v, q, 10000).alias(f"{c}__{n}") for q, n in QUARTILES]
    fields = ["count", "mean", "std", "min", "max"]
    if not exact:
        return _stack(numbers.agg(*aggs), cols, fields + [n for _, n in QUARTILES]).select("column", *DESCRIBED)
    moments = _stack(numbers.agg(*aggs), cols, fields)
    found = quantiles(value_counts_long(numbers, cols, T.DoubleType()), *zip(*QUARTILES))
    return moments.join(F.broadcast(found), "column", "left").select("column", *DESCRIBED)  # one row per column


QUARTILES = ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))
DESCRIBED = ("count", "mean", "std", "min", "p25", "p50", "p75", "max")


def columns_by_keyword(df: DataFrame, keywords: Sequence[str]) -> list[str]:
    """Columns whose name contains any keyword (case-insensitive).  Works on
    the schema only; feed the result to ``profile_distinct``."""
    ks = [k.lower() for k in keywords]
    return [c for c in df.columns if any(k in c.lower() for k in ks)]
