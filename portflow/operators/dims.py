"""Dimension building: calendar, latest attributes, surrogate ids, member
discovery and provenance.

Dimensions are small by nature (ports, modes, lanes, chapters, days); the
operators that need a global order (surrogate ids) run on the distinct
members only, never on fact rows.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from portflow.functions import codes, dates


def calendar(spark: SparkSession, start: str, end: str | Column) -> DataFrame:
    """Dense daily calendar ``[start, end]`` with the model's attributes.

    ``end`` may be a date literal string or a Column of a one-row frame's
    date; the days are produced by ``sequence`` + ``explode``.
    """
    end_c = F.lit(end).cast("date") if isinstance(end, str) else end
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), end_c,
                                                      F.expr("interval 1 day"))).alias("full_date"))
    return calendar_attributes(days, "full_date")


def calendar_attributes(df: DataFrame, d: str = "full_date") -> DataFrame:
    c = F.col(d)
    return df.select(
        dates.date_key(c).alias("date_id"), c.alias("full_date"),
        F.year(c).alias("year"), F.month(c).alias("month"), dates.month_name(c).alias("month_name"),
        F.dayofmonth(c).alias("day"), dates.iso_dow(c).alias("day_of_week"),
        dates.day_name(c).alias("day_of_week_name"), dates.iso_week(c).alias("week_of_year"),
        dates.year_month_str(c).alias("year_month"),
        (dates.iso_dow(c) >= 6).alias("is_weekend"))


def latest_per_key(df: DataFrame, key: str, order_col: str, cols: Sequence[str]) -> DataFrame:
    """Attributes of the latest row per key (``idxmax`` of ``order_col``);
    on equal order values the larger attribute tuple wins deterministically."""
    best = F.max(F.struct(F.col(order_col), *[F.col(c) for c in cols]))
    return df.groupBy(key).agg(best.alias("_b")).select(
        key, F.col("_b")[order_col].alias(order_col), *[F.col("_b")[c].alias(c) for c in cols])


def surrogate_ids(members: DataFrame, natural_key: str, out: str = "id",
                  start_after: int | Column = 0) -> DataFrame:
    """Ids 1.. in natural-key order, continuing after ``start_after``.

    The window is global by definition (one sequence); it runs over the
    distinct members of a dimension, which is small."""
    rn = F.row_number().over(Window.orderBy(natural_key))
    off = start_after if isinstance(start_after, Column) else F.lit(start_after)
    return members.withColumn(out, (rn + off).cast("int"))


def insert_if_absent(new: DataFrame, existing: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key is not in ``existing`` (ON CONFLICT DO NOTHING),
    appended to ``existing``."""
    add = new.join(existing.select(key if isinstance(key, str) else list(key)), key, "left_anti")
    return existing.unionByName(add, allowMissingColumns=True)


def discover_port_members(codes_df: DataFrame, code_col: str, dim: DataFrame, dim_code: str = "port_code") -> DataFrame:
    """Ports seen in fact data but missing from the dimension, as new members.

    Numeric codes become district aggregates, ``ddXX`` codes the residual
    member ``dd99``; state follows the district, flags mark aggregates."""
    parsed = (codes_df.select(F.col(code_col).alias("raw"))
              .where(F.col("raw").rlike(r"^[0-9]{4}$") | codes.is_residual_code(F.col("raw")))
              .select(codes.parse_port_code("raw").alias("port_code")).distinct())
    missing = parsed.join(dim.select(F.col(dim_code).alias("port_code")), "port_code", "left_anti")
    d = codes.district_of("port_code")
    return missing.select(
        codes.synthetic_port_name("port_code").alias("port_canonical_name"), "port_code",
        F.lit("Mexico").alias("country"), F.lit("US-Mexico").alias("border"),
        codes.state_of_district(d).alias("state"),
        F.lit(None).cast("decimal(9,6)").alias("latitude"), F.lit(None).cast("decimal(9,6)").alias("longitude"),
        F.lit(False).alias("is_in_corridor"), F.lit(True).alias("is_aggregate"))


def member_provenance(a: DataFrame, a_col: str, a_name: str, b: DataFrame, b_col: str, b_name: str,
                      out: str = "source_dataset") -> DataFrame:
    """Members of two feeds with where they occur: a_name, b_name or 'both'."""
    x = a.select(F.col(a_col).alias("member")).distinct().withColumn("_a", F.lit(True))
    y = b.select(F.col(b_col).alias("member")).distinct().withColumn("_b", F.lit(True))
    j = x.join(y, "member", "full_outer")
    return j.select("member", F.when(F.col("_a") & F.col("_b"), F.lit("both"))
                               .when(F.col("_a"), F.lit(a_name)).otherwise(F.lit(b_name)).alias(out))
