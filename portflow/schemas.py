"""Declared schemas: raw feeds (never inferred) and the conformed star model."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# --- raw feeds -------------------------------------------------------------
# National monthly trade CSV.  Port and container codes are text: leading
# zeros and the 'XX' residual suffix matter.
NATIONAL_CSV = _struct(
    ("TRDTYPE", I, True), ("DEPE", S, True), ("COMMODITY2", I, True),
    ("DISAGMOT", I, True), ("COUNTRY", I, True), ("VALUE", L, True),
    ("SHIPWT", L, True), ("FREIGHT_CHARGES", L, True), ("DF", D, True),
    ("CONTCODE", S, True), ("MONTH", I, True), ("YEAR", I, True),
)

# Mirror feed JSON pages: every value arrives as text.
MIRROR_JSON = _struct(*[(c, S, True) for c in (
    "year", "month", "port_code", "port_name", "mode_of_transportation", "commodity",
    "trade_type", "container", "production_location", "value", "shipment_weight",
    "freight_charge")])

CROSSING_CSV = _struct(
    ("Port Name", S, True), ("State", S, True), ("Port Code", I, True),
    ("Border", S, True), ("Date", S, True), ("Measure", S, True), ("Value", L, True),
    ("Latitude", D, True), ("Longitude", D, True),
)

WAIT_JSON = _struct(("date", S, True), ("port_name", S, True), ("type", S, True),
                    ("waiting_ave", S, True))

PORT_SUMMARY_JSON = _struct(("port_code", S, True), ("port_name", S, True), ("count", S, True))

COMMODITY_LIST_JSON = _struct(("commodity", S, True))

MANIFEST_CSV = _struct(("url", S, True), ("category", S, True))

# --- conformed model ---------------------------------------------------------
DIM_PORT = _struct(
    ("port_id", L, False), ("port_canonical_name", S, False), ("port_code", I, False),
    ("country", S, False), ("border", S, False), ("state", S, False),
    ("latitude", T.DecimalType(9, 6), True), ("longitude", T.DecimalType(9, 6), True),
    ("is_in_corridor", B, False), ("is_aggregate", B, False),
)

DIM_MODE = _struct(("mode_id", I, False), ("mode_canonical_name", S, False),
                   ("source_dataset", S, False))

DIM_LANE = _struct(("lane_type_id", I, False), ("lane_canonical_name", S, False),
                   ("vehicle_category", S, False), ("is_trusted_traveler", B, False))

FACT_TRADE_COLUMNS = ["port_id", "mode_id", "commodity_id", "date_id", "direction", "container",
                      "production_location", "value_usd", "weight_kg", "freight_charge_usd",
                      "data_source"]
FACT_TRADE_PK = ["port_id", "mode_id", "commodity_id", "date_id", "direction", "container",
                 "production_location"]
FACT_CROSSING_PK = ["port_id", "mode_id", "date_id"]
FACT_WAIT_PK = ["port_id", "lane_type_id", "date_id"]
