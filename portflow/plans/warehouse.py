"""Materialized star model.

At scale the conformed model is built once and read many times: the marts
then scan partitioned Parquet and prune by partition instead of re-deriving
the facts from raw tables.

Layout under ``root`` (a shared folder — by default a sub-folder of the
session's ``spark.checkpoint.dir``):

* ``fact_trade/data_source=../date_id=..`` — deduplicated trade fact, one
  partition per source and month (a few hundred), so the key-range filters
  the marts write (``date_id BETWEEN y0101 AND y1231``) are partition filters
* ``fact_crossing/date_id=..`` — monthly crossings, same pruning
* ``fact_wait`` — the daily wait fact (small: ports x lanes x days)
* ``dim_port``, ``dim_commodity``

Writing a table is also where lineage is cut: readers start from files, so
a lost executor never forces recomputation back to the raw feeds.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portflow.operators import aggregates as agg
from portflow.schemas import FACT_CROSSING_PK, FACT_TRADE_PK
from portflow.session import checkpoint_root, subdir
from portflow.sinks import write_full_refresh
from portflow.sources.testdata import Model, Params


def default_root(spark: SparkSession, name: str = "warehouse") -> str:
    return subdir(checkpoint_root(spark), name)


def build_warehouse(m: Model, root: str) -> str:
    """Conform the bound tables and write the star model under ``root``."""
    trade = agg.dedup_sum(m.trade(), FACT_TRADE_PK + ["data_source"], ["value_usd", "weight_kg", "freight_charge_usd"])
    write_full_refresh(trade, subdir(root, "fact_trade"), ["data_source", "date_id"])
    cross = agg.dedup_sum(m.crossing(), FACT_CROSSING_PK, ["crossing_count"])
    write_full_refresh(cross, subdir(root, "fact_crossing"), ["date_id"])
    write_full_refresh(m.wait(), subdir(root, "fact_wait"))
    write_full_refresh(m.dim_port(), subdir(root, "dim_port"))
    write_full_refresh(m.dim_commodity(), subdir(root, "dim_commodity"))
    return root


@dataclass
class WarehouseModel(Model):
    """``Model`` whose facts and dimensions are read from a built warehouse.

    Mart code is unchanged; its key-range filters on ``date_id`` become
    partition filters on the monthly partitions."""
    root: str = field(default="")

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(subdir(self.root, name))

    def trade(self) -> DataFrame:
        return self._read("fact_trade").withColumn("date_id", F.col("date_id").cast("int"))

    def trade_in_year(self, year: DataFrame) -> DataFrame:
        """One year, known when the query runs: only its monthly partitions are read."""
        lo, hi = (year.select((F.col("year") * 10000 + k).cast("int")).scalar() for k in (101, 1231))
        return self._read("fact_trade").where(F.col("date_id").between(lo, hi)).withColumn("date_id", F.col("date_id").cast("int"))

    def crossing(self) -> DataFrame:
        return self._read("fact_crossing").withColumn("date_id", F.col("date_id").cast("int"))

    def wait(self) -> DataFrame:
        return self._read("fact_wait")

    def dim_port(self) -> DataFrame:
        return self._read("dim_port")

    def dim_commodity(self) -> DataFrame:
        return self._read("dim_commodity")

    def _key(self, *tables: str) -> tuple:
        return tuple(subdir(self.root, t) for t in tables)


def warehouse_model(spark: SparkSession, root: str, p: Params | None = None) -> WarehouseModel:
    return WarehouseModel(spark, sf_dir=root, p=p or Params(), root=root)
