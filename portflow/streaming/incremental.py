"""Incremental loads and streaming aggregates (Structured Streaming).

* ``incremental_national_load`` — new monthly files land in a folder; an
  ``availableNow`` file-source stream says which are new, and each
  micro-batch reads them by column name, adds the port members they bring,
  and replaces exactly the (source, month) partitions it carries.  The
  checkpoint records processed files; facts, rejects and dimension versions
  are all written to places named by month or epoch, so a replayed
  micro-batch changes nothing.
* ``daily_wait_stream`` — raw wait readings -> daily mean per port x lane x
  day with an event-time watermark; readings later than the watermark are
  dropped, everything else equals the batch ``Model.wait`` result.
* ``daily_wait_accounted`` — the same means from a stateful operator that
  does not drop late readings but counts them per port, lane and day.

Checkpoints live under the session's ``spark.checkpoint.dir`` (shared
storage on a cluster); nothing is written to machine-local folders.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from portflow import schemas
from portflow.functions import dates, metrics
from portflow.plans import loads
from portflow.session import checkpoint_root, staged, subdir
from portflow.sinks import with_audit, write_source_partitions
from portflow.sources import files
from portflow.sources.files import national_file_period

FILES_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
#: the dimension as it is before any epoch
FIRST_VERSION = -1


def dimension_versions(spark: SparkSession, path: str) -> DataFrame | None:
    """All versions of a dimension (column ``version``), or None if there are none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def dimension_at(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """The newest version, or the newest that is older than epoch ``before``."""
    every = dimension_versions(spark, path)
    older = every if before is None else every.where(F.col("version") < before)
    newest = older.agg(F.max("version")).first()[0]
    return every.where(F.col("version") == newest).drop("version")


def _upsert_ports(spark: SparkSession, raw: DataFrame, path: str, epoch: int) -> DataFrame:
    """The port dimension with the members that ``raw`` brings; ids of known codes stay.

    Written as version ``epoch`` (from the newest older one, so a replay
    writes the same) if there are new members.
    """
    old = dimension_at(spark, path, before=epoch)
    new = staged(loads.extend_port_dimension(old, raw).select(old.columns), "ports")
    if new.count() == old.count():
        return old
    new.write.mode("overwrite").parquet(subdir(path, f"version={epoch}"))
    return new


def incremental_national_load(spark: SparkSession, source_glob: str, dims: loads.Dims, out_path: str,
                              name: str = "national_load", rejects_path: str | None = None, ports_path: str | None = None) -> int:
    """Process all new national CSV files once (availableNow) and return the
    number of micro-batches run.

    Each national file holds exactly one month, so a micro-batch carries whole
    months and replacing their (source, month) partitions is exact; a
    re-delivered (corrected) month file replaces that month.  With
    ``ports_path`` the port dimension is kept there in versions, starting from
    ``dims.port``, and codes that a batch brings for the first time become
    members before its rows are looked up.  Rejected rows replace their
    epoch's partition.  A task or executor lost mid-batch is retried by Spark;
    a driver restart resumes from the checkpoint and the replayed batch
    overwrites the same partitions."""
    stream = (spark.readStream.format("binaryFile").schema(FILES_SCHEMA).option("maxFilesPerTrigger", 16).load(source_glob)
              .select("path"))   # the listing alone: contents are read by name below
    if ports_path and dimension_versions(spark, ports_path) is None:
        dims.port.write.mode("overwrite").parquet(subdir(ports_path, f"version={FIRST_VERSION}"))
    batches = []

    def on_batch(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        new = [r["path"] for r in batch.where(national_file_period("path").isNotNull()).select("path").collect()]  # at most maxFilesPerTrigger
        if new:
            raw = files.read_csv_by_name(spark, new, schemas.NATIONAL_CSV)
            d = dims if not ports_path else loads.Dims(_upsert_ports(spark, raw, ports_path, epoch), dims.mode, dims.commodity, dims.lane)
            fact, rejected = loads.conform_national(raw, d)
            write_source_partitions(with_audit(loads.collapse_trade_duplicates(fact)), out_path, ["data_source", "date_id"])
            if rejects_path:
                rejected.write.mode("overwrite").parquet(subdir(rejects_path, f"epoch={epoch}"))
        batches.append(epoch)

    q = (stream.writeStream.foreachBatch(on_batch)
         .option("checkpointLocation", subdir(checkpoint_root(spark), "streams", name))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(batches)


def daily_wait_stream(events: DataFrame, port: F.Column, lane: F.Column, ts: str = "ts",
                      value: str = "value", lateness: str = "1 day") -> DataFrame:
    """Streaming daily mean (half up to 2 decimals) per port x lane x day.

    ``events`` is a streaming DataFrame; the watermark bounds the state kept
    per open day and drops readings that arrive later than ``lateness``.
    """
    # event-time watermarks need TIMESTAMP; under the UTC session zone the
    # cast keeps the wall-clock day of a TIMESTAMP_NTZ reading
    x = events.select(port.alias("port_id"), lane.alias("lane_type_id"), F.col(ts).cast("timestamp").alias("ts"),
                      F.col(value).cast("decimal(6,2)").alias("minutes"))
    g = (x.withWatermark("ts", lateness)
          .groupBy(F.window("ts", "1 day").alias("w"), "port_id", "lane_type_id")
          .agg(F.sum(metrics.cents("minutes")).alias("_c"), F.count(F.lit(1)).alias("_n")))
    return g.select("port_id", "lane_type_id", dates.date_key(F.col("w.start")).alias("date_id"),
                    metrics.mean_half_up("_c", "_n").cast("decimal(6,2)").alias("waiting_avg_minutes"))


ACCOUNTED = ("port_id long, lane_type_id int, date_id int, waiting_avg_minutes decimal(6,2), readings long, "
             "late_readings long, late_cents long")


def daily_wait_accounted(events: DataFrame, port: F.Column, lane: F.Column, ts: str = "ts", value: str = "value",
                         lateness: str = "1 day") -> DataFrame:
    """Streaming daily means that account for late readings.

    One row per port x lane x day and micro-batch with readings of it: the
    mean so far and its readings, and the readings of this batch that came
    after the watermark had passed the day's end (with their sum in
    hundredths), which the mean leaves out as ``daily_wait_stream`` does.  The
    state is two numbers per row of the daily fact (an event-time timeout
    would drop late readings before they could be counted).
    """
    x = events.select(port.cast("long").alias("port_id"), lane.cast("int").alias("lane_type_id"), F.col(ts).cast("timestamp").alias("ts"),
                      metrics.cents(F.col(value).cast("decimal(6,2)")).cast("long").alias("cents"))
    x = x.withWatermark("ts", lateness).withColumn("day", F.to_date("ts"))

    def update(key, pieces: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        end = (pd.Timestamp(key[2]) + pd.Timedelta(days=1)).value // 1_000_000
        closed = 0 < end <= state.getCurrentWatermarkMs()
        total, n = state.get if state.exists else (0, 0)
        cents, rows = 0, 0
        for piece in pieces:
            known = piece["cents"].dropna()   # a reading without a value has no part in the mean
            cents, rows = cents + int(known.sum()), rows + len(known)
        if not closed:
            total, n = total + cents, n + rows
            state.update((total, n))
        mean = (Decimal(total) / n / 100).quantize(Decimal("0.01"), ROUND_HALF_UP) if n else None
        day = pd.Timestamp(key[2])
        yield pd.DataFrame({"port_id": [key[0]], "lane_type_id": [key[1]], "date_id": [day.year * 10000 + day.month * 100 + day.day], "waiting_avg_minutes": [mean],
                            "readings": [n], "late_readings": [rows if closed else 0], "late_cents": [cents if closed else 0]})

    return x.groupBy("port_id", "lane_type_id", "day").applyInPandasWithState(update, ACCOUNTED, "total long, n long", "update", GroupStateTimeout.NoTimeout)


def write_accounted(stream: DataFrame, path: str, name: str) -> int:
    """Run ``daily_wait_accounted`` over all that has come; updates go to one partition per epoch.  Returns the batches run."""
    batches = []

    def on_batch(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(subdir(path, f"epoch={epoch}"))   # a replayed epoch writes its own partition again
        batches.append(epoch)

    q = (stream.writeStream.outputMode("update").foreachBatch(on_batch).option("checkpointLocation", subdir(checkpoint_root(stream.sparkSession), "streams", name))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(batches)


def accounted_days(spark: SparkSession, path: str) -> DataFrame:
    """Per port x lane x day: the last mean and its readings, and all late readings."""
    x = spark.read.parquet(path)
    on_time = F.when(F.col("late_readings") == 0, F.struct("epoch", "waiting_avg_minutes", "readings"))
    last = F.max(on_time)
    return x.groupBy("port_id", "lane_type_id", "date_id").agg(
        last["waiting_avg_minutes"].alias("waiting_avg_minutes"), F.coalesce(last["readings"], F.lit(0)).alias("readings"),
        F.sum("late_readings").alias("late_readings"), F.sum("late_cents").alias("late_cents"))
