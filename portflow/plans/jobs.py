"""End-to-end load job: raw feeds -> warehouse the marts read.

Steps (each output is written before the next step reads it, so lineage is
cut at every table and a lost executor never recomputes upstream feeds):

1. ports from the crossing feed (latest attributes, sorted ids, corridor
   flag), extended with members discovered in the national feed;
   modes, lanes and commodity chapters as dimensions.
2. national trade: conform -> quarantine rejects -> collapse duplicates.
3. mirror trade: conform -> abort on duplicate keys or on months already
   served by the national source -> append as its own source partitions.
4. crossings and waits: conform -> quarantine -> collapse.

The layout is the one ``plans.warehouse.WarehouseModel`` reads.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portflow import catalogs, schemas
from portflow.operators import dims as dimops
from portflow.plans import loads
from portflow.session import subdir
from portflow.sinks import with_audit, write_full_refresh, write_source_partitions
from portflow.sources import archives, files, ranged


@dataclass
class FeedPaths:
    national: str | list | None   # CSV glob(s) of the monthly national files
    crossing: str                 # crossing CSV
    wait: str | None = None       # wait JSON pages
    mirror: str | None = None     # mirror JSON pages
    archives: str | None = None   # archives of national files; months that ``national`` has are left to it
    calendar: tuple = ("1996-01-01", None)   # first and last day of dim_date (None: the day of the load)


def mode_dimension(spark: SparkSession) -> DataFrame:
    rows = [(i + 1, n, s) for i, (n, s) in enumerate(catalogs.CANONICAL_MODES)]
    return spark.createDataFrame(rows, "mode_id int, mode_canonical_name string, source_dataset string")


def lane_dimension(spark: SparkSession) -> DataFrame:
    rows = [(i + 1, n, c, t) for i, (n, c, t) in enumerate(catalogs.LANE_TYPES)]
    return spark.createDataFrame(
        rows, "lane_type_id int, lane_canonical_name string, vehicle_category string, is_trusted_traveler boolean")


def commodity_dimension(spark: SparkSession, chapters: list[tuple[int, str, str]] | None = None) -> DataFrame:
    """(hs2_code, full description, sector) -> ids in code order."""
    rows = chapters if chapters is not None else catalogs.HS2_CHAPTERS
    df = spark.createDataFrame(rows, "hs2_code int, hs2_description_full string, sector_grouping string")
    df = df.withColumn("hs2_description_short", F.trim(F.split(F.col("hs2_description_full"), "[;,]").getItem(0)))
    return dimops.surrogate_ids(df, "hs2_code", "commodity_id")


def _write(df: DataFrame, root: str, name: str, partition_by=()) -> DataFrame:
    path = subdir(root, name)
    write_full_refresh(df, path, list(partition_by))
    return df.sparkSession.read.parquet(path)


def national_rows(spark: SparkSession, feeds: FeedPaths) -> DataFrame:
    """In-scope monthly files, loose ones and those in archives; a month comes from its first copy, loose files first."""
    rows, taken = [], None
    if feeds.national:
        loose = files.read_csv_by_name(spark, feeds.national, schemas.NATIONAL_CSV)
        period = files.national_file_period
        rows.append(loose.where(period("_file").isNotNull()))
        names = ranged.list_files(spark, [feeds.national] if isinstance(feeds.national, str) else feeds.national)
        taken = names.select(period("path").alias("period")).where("period IS NOT NULL")
    if feeds.archives:
        report = archives.member_report(archives.member_directory(spark, feeds.archives))
        rows.append(archives.read_archived_csv(archives.first_copies(report, taken), schemas.NATIONAL_CSV))
    if not rows:
        raise ValueError("no national feed given")
    return rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1])


def load_feeds(spark: SparkSession, feeds: FeedPaths, root: str,
               chapters: list[tuple[int, str, str]] | None = None) -> dict[str, int]:
    """Run the whole load; returns row counts per written table."""
    # columns are taken by name: files may order or lack columns as they like
    cross_raw = files.read_csv_by_name(spark, feeds.crossing, schemas.CROSSING_CSV)
    nat_raw = national_rows(spark, feeds)

    ports = loads.build_port_dimension(cross_raw, catalogs.CORRIDOR_PORTS)
    ports = _write(loads.extend_port_dimension(ports, nat_raw), root, "dim_port")
    mode = _write(mode_dimension(spark), root, "dim_mode")
    com = _write(commodity_dimension(spark, chapters), root, "dim_commodity")
    lane = _write(lane_dimension(spark), root, "dim_lane")
    first, last = feeds.calendar
    _write(dimops.calendar(spark, first, last or F.current_date()), root, "dim_date")
    d = loads.Dims(port=ports, mode=mode, commodity=com, lane=lane)

    nat, nat_rej = loads.conform_national(nat_raw, d)
    trade = _write(with_audit(loads.collapse_trade_duplicates(nat)), root, "fact_trade", ["data_source", "date_id"])
    _write(nat_rej.withColumn("feed", F.lit("national")), root, "rejects_trade")
    if feeds.mirror:
        mir_raw = files.read_json_pages(spark, feeds.mirror, schemas.MIRROR_JSON)
        mir, mir_rej = loads.conform_mirror(mir_raw, d)
        loads.assert_no_duplicates(mir)
        loads.assert_no_overlap(trade.where(F.col("data_source") == catalogs.SOURCE_NATIONAL), mir)
        write_source_partitions(with_audit(mir), subdir(root, "fact_trade"), ["data_source", "date_id"])
        write_full_refresh(mir_rej.withColumn("feed", F.lit("mirror")), subdir(root, "rejects_trade_mirror"))

    cross, cross_rej = loads.conform_crossing(cross_raw, d)
    _write(with_audit(cross), root, "fact_crossing", ["date_id"])
    _write(cross_rej, root, "rejects_crossing")
    if feeds.wait:
        wait, wait_rej = loads.conform_wait(files.read_json_pages(spark, feeds.wait, schemas.WAIT_JSON), d)
        _write(with_audit(wait), root, "fact_wait")
        _write(wait_rej, root, "rejects_wait")
    else:
        _write(spark.createDataFrame([], "port_id long, lane_type_id int, date_id int, "
                                         "waiting_avg_minutes decimal(6,2)"), root, "fact_wait")

    out = {}
    for t in ("dim_port", "fact_trade", "fact_crossing", "fact_wait"):
        out[t] = spark.read.parquet(subdir(root, t)).count()
    return out


def focus_port_id(spark: SparkSession, root: str, name: str) -> int | None:
    """Surrogate id of a port by canonical name (one-row lookup)."""
    r = spark.read.parquet(subdir(root, "dim_port")).where(F.col("port_canonical_name") == name) \
        .select("port_id").limit(1).collect()
    return int(r[0][0]) if r else None

