"""Registry of checked queries: key -> Spark callable, key -> DuckDB SQL.

returns a lazy DataFrame over the whole driver tables.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portflow.plans import marts, oracle
from portflow.sources.testdata import model

Query = Callable[[SparkSession, str], DataFrame]

_MARTS = [
    "mart_meta", "mart_panorama_kpis", "mart_value_timeline", "mart_crossings_timeline", "mart_top_ports",
    "mart_focus_kpis", "mart_focus_monthly", "mart_focus_yearly", "mart_sector_mix", "mart_sector_history",
    "mart_density_ratio", "mart_asymmetry", "mart_wait_kpis", "mart_wait_heatmap", "mart_lane_savings",
    "mart_wait_trend", "mart_recovery_kpis", "mart_dual_series", "mart_density_trend",
]


def _mart(name: str) -> Query:
    fn = getattr(marts, name)
    return lambda spark, sf_dir: fn(model(spark, sf_dir))


QUERIES: dict[str, Query] = {name: _mart(name) for name in _MARTS}
ORACLE: dict[str, str] = {name: getattr(oracle, name)() for name in _MARTS}


def _heatmap_text(m) -> DataFrame:
    values = F.transform("week_values", lambda v: F.when(v.isNull(), F.lit("null")).otherwise(v.cast("decimal(10,2)").cast("string")))
    return marts.heatmap_matrix(m).withColumn("week_values", F.array_join(values, ","))


def _series_text(m) -> DataFrame:
    def point(x):
        return F.concat_ws(":", x["year_month"], F.coalesce(x["avg_min"].cast("decimal(10,2)").cast("string"), F.lit("null")), x["n_days"].cast("string"))
    return marts.series_map(m).withColumn("series", F.array_join(F.transform("series", point), ","))


# marts whose output nests arrays: compared as text
for _name, _fn in (("heatmap_matrix", _heatmap_text), ("series_map", _series_text), ("combos_default", marts.combos_default)):
    QUERIES[_name] = lambda spark, d, fn=_fn: fn(model(spark, d))
    ORACLE[_name] = getattr(oracle, _name)()


def register(key: str, query: Query, sql: str | None = None) -> None:
    QUERIES[key] = query
    if sql is not None:
        ORACLE[key] = sql


def _load_operator_keys() -> None:
    # operator-level keys live next to their SQL in plans.checks
    from portflow.plans import checks  # noqa: F401  (registers on import)


_load_operator_keys()
