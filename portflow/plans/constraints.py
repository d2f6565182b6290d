"""The constraints of the star schema, as data for ``operators.rules``."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portflow import catalogs
from portflow.operators import dims
from portflow.operators.rules import TableRules
from portflow.session import subdir
from portflow.sinks import with_audit


def one_of(column: str, values: Sequence[str]) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


# FIXED VALUES: columns, lengths and domains of the schema.
BORDERS = ("US-Mexico", "US-Canada")
DIRECTIONS = ("Import", "Export")
CONTAINERS = ("Containerized", "Not Containerized", "Unknown")
LOCATIONS = ("Domestically Produced Goods", "Foreign Produced Goods", "N/A")
SOURCES = (catalogs.SOURCE_NATIONAL, catalogs.SOURCE_MIRROR)


def star_schema(borders: Sequence[str] = BORDERS) -> dict[str, TableRules]:
    """Rules by table; ``borders`` are the names that a model binds as borders."""
    return {
        "dim_port": TableRules(
            not_null=("port_id", "port_canonical_name", "port_code", "country", "border", "state", "is_in_corridor"),
            max_len={"port_canonical_name": 50, "country": 10, "border": 10, "state": 20},
            checks={"country": one_of("country", ("Mexico", "Canada")), "border": one_of("border", borders)},
            unique=(("port_id",), ("port_canonical_name",), ("port_code",))),
        "dim_mode": TableRules(
            not_null=("mode_id", "mode_canonical_name", "source_dataset"), max_len={"mode_canonical_name": 40, "source_dataset": 20},
            checks={"source_dataset": one_of("source_dataset", ("border_crossing", "transborder", "both"))},
            unique=(("mode_id",), ("mode_canonical_name",))),
        "dim_commodity": TableRules(
            not_null=("commodity_id", "hs2_code", "hs2_description_short", "hs2_description_full", "sector_grouping"),
            max_len={"hs2_description_short": 80, "sector_grouping": 30}, checks={"hs2_code": "hs2_code BETWEEN 1 AND 99"},
            unique=(("commodity_id",), ("hs2_code",))),
        "dim_date": TableRules(
            not_null=("date_id", "full_date", "year", "month", "month_name", "day", "day_of_week", "day_of_week_name", "week_of_year", "year_month"),
            max_len={"month_name": 10, "day_of_week_name": 10, "year_month": 7},
            checks={"month": "month BETWEEN 1 AND 12", "day": "day BETWEEN 1 AND 31", "day_of_week": "day_of_week BETWEEN 1 AND 7",
                    "week_of_year": "week_of_year BETWEEN 1 AND 53"},
            unique=(("date_id",), ("full_date",))),
        "dim_lane": TableRules(
            not_null=("lane_type_id", "lane_canonical_name", "vehicle_category", "is_trusted_traveler"),
            max_len={"lane_canonical_name": 40, "vehicle_category": 15},
            checks={"vehicle_category": one_of("vehicle_category", ("Commercial", "POV", "Pedestrian"))},
            unique=(("lane_type_id",), ("lane_canonical_name",))),
        "fact_crossing": TableRules(
            not_null=("port_id", "mode_id", "date_id", "crossing_count", "loaded_at"), checks={"crossing_count": "crossing_count >= 0"},
            foreign={"port_id": ("dim_port", "port_id"), "mode_id": ("dim_mode", "mode_id"), "date_id": ("dim_date", "date_id")}),
        "fact_trade": TableRules(
            not_null=("port_id", "mode_id", "commodity_id", "date_id", "direction", "container", "production_location", "value_usd", "data_source", "loaded_at"),
            max_len={"direction": 6, "container": 20, "production_location": 30, "data_source": 20},
            checks={"direction": one_of("direction", DIRECTIONS), "container": one_of("container", CONTAINERS),
                    "production_location": one_of("production_location", LOCATIONS), "value_usd": "value_usd >= 0",
                    "weight_kg": "weight_kg IS NULL OR weight_kg >= 0", "freight_charge_usd": "freight_charge_usd IS NULL OR freight_charge_usd >= 0",
                    "data_source": one_of("data_source", SOURCES)},
            foreign={"port_id": ("dim_port", "port_id"), "mode_id": ("dim_mode", "mode_id"), "commodity_id": ("members", "commodity_id"),
                     "date_id": ("dim_date", "date_id")}),
        "fact_wait": TableRules(
            not_null=("port_id", "lane_type_id", "date_id", "waiting_avg_minutes", "loaded_at"), checks={"waiting_avg_minutes": "waiting_avg_minutes >= 0"},
            foreign={"port_id": ("dim_port", "port_id"), "lane_type_id": ("dim_lane", "lane_type_id"), "date_id": ("dim_date", "date_id")}),
    }


def model_frames(m) -> dict[str, DataFrame]:
    """The tables of a model; its commodities (``members``) are parts, the chapters are the literal dimension."""
    from portflow.plans.jobs import commodity_dimension
    return {"dim_port": m.dim_port(), "dim_mode": m.dim_mode(), "dim_lane": m.dim_lane(), "dim_commodity": commodity_dimension(m.spark), "members": m.dim_commodity(),
            "dim_date": dims.calendar(m.spark, m.p.calendar_start, m.p.calendar_end), "fact_trade": with_audit(m.trade()),
            "fact_crossing": with_audit(m.crossing()), "fact_wait": with_audit(m.wait())}


def warehouse_frames(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables that ``jobs.load_feeds`` has written."""
    names = ("dim_port", "dim_mode", "dim_lane", "dim_commodity", "dim_date", "fact_trade", "fact_crossing", "fact_wait")
    out = {n: spark.read.parquet(subdir(root, n)) for n in names}
    return out | {"members": out["dim_commodity"], "fact_trade": out["fact_trade"].withColumn("date_id", F.col("date_id").cast("int"))}
