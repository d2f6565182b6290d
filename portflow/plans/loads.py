"""Load jobs: raw feed rows -> conformed fact rows + rejected rows.

Order matters and is kept: scope filters, then code mapping and lookups,
then the reject split, then the export-weight nullify, then the duplicate
collapse.  Every function returns lazy DataFrames; writing is left to the
caller (see ``sinks``), so one job can write the fact and its quarantine
from the same plan.

Dimension lookups are left joins against small dimensions (broadcast behind
a size check), so misses stay visible as NULL ids until the reject split.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from portflow import catalogs
from portflow.functions import codes, dates
from portflow.operators import aggregates as agg
from portflow.operators import conform, dims, joins
from portflow.schemas import FACT_CROSSING_PK, FACT_TRADE_COLUMNS, FACT_TRADE_PK, FACT_WAIT_PK


class LoadAborted(RuntimeError):
    """A load policy refused the input (duplicates, overlapping sources)."""


@dataclass
class Dims:
    port: DataFrame        # port_id, port_code, port_canonical_name, ...
    mode: DataFrame        # mode_id, mode_canonical_name
    commodity: DataFrame   # commodity_id, hs2_code, hs2_description_full
    lane: DataFrame | None = None   # lane_type_id, lane_canonical_name


def _lookup(df: DataFrame, dim: DataFrame, left_key: Column, dim_key: str, value: str, out: str) -> DataFrame:
    # one row per key: a key that two members share must not double the fact's rows
    d = dim.groupBy(F.col(dim_key).alias("_lk")).agg(F.min(value).alias(out))
    return joins.lookup_join(df.withColumn("_lk", left_key), d, "_lk", "left").drop("_lk")


def _trade_tail(x: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """Reject split -> nullify export zero weights -> tag -> columns."""
    acc, rej = conform.reject_split(x, {"port_unmapped": F.col("port_id"), "mode_unmapped": F.col("mode_id"),
                                        "commodity_unmapped": F.col("commodity_id"),
                                        "direction_unmapped": F.col("direction"),
                                        "bad_value": F.col("value_usd"), "bad_date": F.col("date_id")})
    acc = (acc.withColumn("weight_kg", conform.nullify_when("weight_kg", (F.col("direction") == "Export")
                                                              & (F.col("weight_kg") == 0)))
              .withColumn("data_source", F.lit(source)))
    return acc.select(*FACT_TRADE_COLUMNS), rej


def conform_national(raw: DataFrame, d: Dims, country: int = catalogs.TRADE_COUNTRY_CODE) -> tuple[DataFrame, DataFrame]:
    """National CSV rows -> (fact rows before dedup, rejected rows)."""
    x = conform.filter_eq(raw, "COUNTRY", country)
    x = _lookup(x, d.port, codes.parse_port_code("DEPE"), "port_code", "port_id", "port_id")
    x = _lookup(x, d.mode, codes.map_values("DISAGMOT", catalogs.TRADE_MODE_CODE_TO_MODE), "mode_canonical_name",
                "mode_id", "mode_id")
    x = _lookup(x, d.commodity, F.col("COMMODITY2"), "hs2_code", "commodity_id", "commodity_id")
    x = x.select(
        "*",
        codes.map_values("TRDTYPE", catalogs.TRADE_TYPE_TO_DIRECTION).alias("direction"),
        codes.map_values("CONTCODE", catalogs.CONTAINER_CODE_TO_LABEL, "Unknown").alias("container"),
        codes.map_values("DF", catalogs.ORIGIN_FLAG_TO_LOCATION, "N/A").alias("production_location"),
        F.when(F.col("MONTH").between(1, 12) & F.col("YEAR").between(1900, 2999),
               F.col("YEAR") * 10000 + F.col("MONTH") * 100 + 1).cast("int").alias("date_id"),
        F.col("VALUE").alias("value_usd"), F.col("SHIPWT").alias("weight_kg"),
        F.col("FREIGHT_CHARGES").alias("freight_charge_usd"))
    return _trade_tail(x, catalogs.SOURCE_NATIONAL)


def collapse_trade_duplicates(fact: DataFrame) -> DataFrame:
    """Sum duplicate primary keys; weight/freight stay NULL when all NULL."""
    return agg.dedup_sum(fact, FACT_TRADE_PK + ["data_source"], ["value_usd", "weight_kg", "freight_charge_usd"])


def conform_mirror(raw: DataFrame, d: Dims) -> tuple[DataFrame, DataFrame]:
    """Mirror JSON rows (all text) -> (fact rows, rejected rows).

    ``value`` is required and cast strictly (bad text fails the job, as the
    source contract demands); weight and freight are optional (try_cast).
    Commodity text is matched by its normalized form to the chapter list.
    """
    x = raw.select(
        "*",
        (F.col("year").cast("int") * 10000 + F.col("month").cast("int") * 100 + 1).alias("date_id"),
        conform.strict_long("value").alias("value_usd"),
        conform.try_long("shipment_weight").alias("weight_kg"),
        conform.try_long("freight_charge").alias("freight_charge_usd"),
        F.col("trade_type").alias("direction"),
        F.coalesce(F.col("container"), F.lit("Unknown")).alias("container_v"),
        F.coalesce(F.col("production_location"), F.lit("N/A")).alias("production_location_v"))
    x = x.drop("container", "production_location").withColumnRenamed("container_v", "container") \
         .withColumnRenamed("production_location_v", "production_location")
    pc = F.when(codes.is_digits("port_code"), F.col("port_code").cast("int"))
    x = _lookup(x, d.port, pc, "port_code", "port_id", "port_id")
    x = _lookup(x, d.mode, codes.map_values("mode_of_transportation", catalogs.MIRROR_MODE_TO_MODE),
                "mode_canonical_name", "mode_id", "mode_id")
    cat = d.commodity.select(codes.normalize_text("hs2_description_full").alias("_norm"), "commodity_id")
    x = _lookup(x, cat, codes.normalize_text("commodity"), "_norm", "commodity_id", "commodity_id")
    x = x.withColumn("direction", F.when(F.col("direction").isin("Import", "Export"), F.col("direction")))
    return _trade_tail(x, catalogs.SOURCE_MIRROR)


def assert_no_duplicates(fact: DataFrame, pk=FACT_TRADE_PK) -> None:
    """Abort policy of the mirror source: any duplicate key stops the load."""
    n = agg.dup_groups(fact, pk).limit(1).count()
    if n:
        raise LoadAborted("duplicate primary keys in the mirror feed; load aborted")


def assert_no_overlap(existing: DataFrame, incoming: DataFrame, source_col: str = "data_source") -> None:
    """Abort when the incoming months are already loaded from another source."""
    months = incoming.select("date_id").distinct()
    clash = existing.join(months, "date_id", "left_semi").limit(1).count()
    if clash:
        raise LoadAborted("incoming months overlap rows of another source; load aborted")


def conform_crossing(raw: DataFrame, d: Dims) -> tuple[DataFrame, DataFrame]:
    """Crossing CSV -> (fact rows with duplicates summed, rejected rows)."""
    x = conform.filter_eq(raw, "Border", catalogs.CROSSING_BORDER)
    x = conform.exclude_value(x, "Port Name", catalogs.CROSSING_EXCLUDED_PORT)
    month = dates.parse_month_year("Date")
    x = x.select("*", month.alias("_month"), dates.month_key(month).alias("date_id"))
    x = _lookup(x, d.port, F.col("Port Name"), "port_canonical_name", "port_id", "port_id")
    x = _lookup(x, d.mode, codes.map_values("Measure", catalogs.CROSSING_MEASURE_TO_MODE), "mode_canonical_name",
                "mode_id", "mode_id")
    acc, rej = conform.reject_split(x, {"bad_date": F.col("_month"), "port_unmapped": F.col("port_id"),
                                        "mode_unmapped": F.col("mode_id"), "bad_value": F.col("Value")})
    fact = agg.dedup_sum(acc.withColumnRenamed("Value", "crossing_count"), FACT_CROSSING_PK, ["crossing_count"])
    return fact, rej


def conform_wait(raw: DataFrame, d: Dims) -> tuple[DataFrame, DataFrame]:
    """Wait JSON -> (daily fact, rejected rows): minutes rounded on ingest,
    duplicates of (port, lane, day) averaged and rounded again."""
    ts = dates.parse_iso_timestamp("date")
    x = raw.select("*", ts.alias("_ts"), dates.date_key(F.to_date(ts)).alias("date_id"),
                   conform.round_ingest("waiting_ave").alias("minutes"))
    x = _lookup(x, d.port, codes.map_values("port_name", catalogs.WAIT_PORT_TO_PORT), "port_canonical_name",
                "port_id", "port_id")
    x = _lookup(x, d.lane, codes.map_values("type", catalogs.WAIT_LANE_TO_LANE), "lane_canonical_name",
                "lane_type_id", "lane_type_id")
    acc, rej = conform.reject_split(x, {"bad_date": F.col("_ts"), "port_unmapped": F.col("port_id"),
                                        "lane_unmapped": F.col("lane_type_id")})
    fact = agg.dedup_mean(acc, FACT_WAIT_PK, "minutes", "waiting_avg_minutes") \
        .withColumn("waiting_avg_minutes", F.col("waiting_avg_minutes").cast("decimal(6,2)"))
    return fact, rej


def build_port_dimension(crossing_raw: DataFrame, corridor: tuple = ("San Ysidro", "Otay Mesa", "Tecate")) -> DataFrame:
    """Ports of the crossing feed: latest attributes per port name, ids in
    name order, corridor flag by membership."""
    x = conform.filter_eq(crossing_raw, "Border", catalogs.CROSSING_BORDER)
    x = conform.exclude_value(x, "Port Name", catalogs.CROSSING_EXCLUDED_PORT)
    x = x.where(F.col("Port Name").isNotNull()).withColumn("_d", dates.parse_month_year("Date"))
    latest = dims.latest_per_key(x, "Port Name", "_d", ["Port Code", "State", "Latitude", "Longitude"])
    ports = latest.select(
        F.col("Port Name").alias("port_canonical_name"), F.col("Port Code").cast("int").alias("port_code"),
        F.lit("Mexico").alias("country"), F.lit("US-Mexico").alias("border"), F.col("State").alias("state"),
        F.col("Latitude").cast("decimal(9,6)").alias("latitude"), F.col("Longitude").cast("decimal(9,6)").alias("longitude"),
        F.col("Port Name").isin(*corridor).alias("is_in_corridor"), F.lit(False).alias("is_aggregate"))
    return dims.surrogate_ids(ports, "port_canonical_name", "port_id").withColumn("port_id", F.col("port_id").cast("long"))


def extend_port_dimension(dim_port: DataFrame, national_raw: DataFrame) -> DataFrame:
    """Append members discovered in the national feed (aggregates and
    residuals), ids continuing after the current maximum; existing codes are
    left untouched (insert-if-absent).

    The current maximum id (a one-row aggregate) is stacked onto the new
    members and spread with a window over that small frame — no join."""
    new = dims.discover_port_members(conform.filter_eq(national_raw, "COUNTRY", catalogs.TRADE_COUNTRY_CODE),
                                     "DEPE", dim_port)
    top = dim_port.agg(F.coalesce(F.max("port_id"), F.lit(0)).alias("_m"))
    x = new.unionByName(top, allowMissingColumns=True)
    x = x.withColumn("_m", F.max("_m").over(Window.partitionBy())).where(F.col("port_code").isNotNull())
    x = dims.surrogate_ids(x, "port_code", "port_id", start_after=F.col("_m")).drop("_m")
    return dims.insert_if_absent(x.withColumn("port_id", F.col("port_id").cast("long")), dim_port, "port_code")
