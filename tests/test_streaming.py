"""Structured Streaming jobs: incremental load re-run safety, and the
streaming daily wait aggregate equal to the batch one."""

import os
import shutil

from pyspark.sql import functions as F

from portflow.sources.testdata import EVENT_TYPE_TO_LANE, Params, model, wait_port_of
from portflow import catalogs
from portflow.functions import codes
from portflow.session import checkpoint_root
from portflow.streaming.incremental import (accounted_days, daily_wait_accounted, daily_wait_stream, dimension_at, incremental_national_load,
                                            write_accounted)

from tests.test_loads import NAT_HEADER, NAT_ROWS, _dims, _write

SF = "/root/testdata/sf0.001"


def test_incremental_load_is_rerun_safe(spark, workdir):
    src, out = f"{workdir}/in", f"{workdir}/fact"
    _write(f"{src}/2024-03/dot3_0324.csv", NAT_HEADER + "\n" + "\n".join(NAT_ROWS[:5]) + "\n")
    d = _dims(spark)
    name = os.path.basename(workdir)
    assert incremental_national_load(spark, f"{src}/*/*.csv", d, out, name=name) >= 1
    first = sorted(tuple(r) for r in spark.read.parquet(out).select("date_id", "port_id", "value_usd").collect())
    # a second run without new files processes nothing and changes nothing
    incremental_national_load(spark, f"{src}/*/*.csv", d, out, name=name)
    again = sorted(tuple(r) for r in spark.read.parquet(out).select("date_id", "port_id", "value_usd").collect())
    assert first == again
    # a new month only adds its own partition
    _write(f"{src}/2024-04/dot3_0424.csv", NAT_HEADER + "\n" + NAT_ROWS[0].replace(",3,2024", ",4,2024") + "\n")
    incremental_national_load(spark, f"{src}/*/*.csv", d, out, name=name)
    rows = spark.read.parquet(out).groupBy("date_id").count().collect()
    assert {r.date_id: r["count"] for r in rows} == {20240301: 3, 20240401: 1}


def test_streaming_daily_wait_equals_batch(spark, workdir):
    src = f"{workdir}/events"
    os.makedirs(src)
    shutil.copy(f"{SF}/events.parquet", f"{src}/part-0.parquet")
    schema = spark.read.parquet(src).schema
    stream = spark.readStream.schema(schema).parquet(src)
    lanes = {k: catalogs.lane_ids()[v] for k, v in EVENT_TYPE_TO_LANE.items()}
    out = daily_wait_stream(stream, wait_port_of(F.col("user_id"), Params()), codes.map_values("event_type", lanes))
    name = "wait_" + os.path.basename(workdir).replace("-", "_")
    q = (out.writeStream.outputMode("update").format("memory").queryName(name)
         .option("checkpointLocation", f"{workdir}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted(tuple(r) for r in spark.table(name).collect())
    want = sorted(tuple(r) for r in model(spark, SF).wait().collect())
    assert got == want and len(got) > 0


PORTS = "port_id long, port_canonical_name string, port_code int, country string, border string, state string, latitude decimal(9,6), longitude decimal(9,6), is_in_corridor boolean, is_aggregate boolean"


def _snapshot(spark, path, *drop):
    df = spark.read.parquet(path).drop("loaded_at", *drop)
    return sorted((tuple(map(str, r)) for r in df.select(sorted(df.columns)).collect()))


def test_new_members_are_loaded_and_replays_change_nothing(spark, workdir):
    """A residual code that no batch brought before becomes a member; a replayed epoch writes the same bytes' worth."""
    src, out, rejects, ports = (f"{workdir}/{x}" for x in ("in", "fact", "rejects", "ports"))
    d = _dims(spark)
    known = [(k, n, c, "Mexico", "US-Mexico", "California", None, None, True, False) for k, n, c in ((1, "Otay Mesa", 2504), (2, "San Ysidro", 2501), (3, "Laredo", 2302))]
    d.port = spark.createDataFrame(known, PORTS)
    reversed_columns = lambda line: ",".join(line.split(",")[::-1])
    _write(f"{src}/2024-03/dot3_0324.csv", NAT_HEADER + "\n" + "\n".join(NAT_ROWS) + "\n")
    name = os.path.basename(workdir)

    def load():
        incremental_national_load(spark, f"{src}/*/*.csv", d, out, name=name, rejects_path=rejects, ports_path=ports)

    load()
    members = {r["port_code"]: r["port_id"] for r in dimension_at(spark, ports).collect()}
    assert members[2504] == 1 and members[2599] > 3
    assert spark.read.parquet(out).where(F.col("port_id") == members[2599]).count() == 1
    before = _snapshot(spark, out), _snapshot(spark, rejects), _snapshot(spark, ports)
    # the driver is lost after the batch's writes, before its commit: the epoch is run again
    commits = f"{checkpoint_root(spark).removeprefix('file:')}/streams/{name}/commits"
    os.rename(f"{commits}/0", f"{workdir}/commit-0")
    crc = f"{commits}/.0.crc"
    if os.path.exists(crc):
        os.rename(crc, f"{workdir}/commit-0.crc")
    load()
    assert (_snapshot(spark, out), _snapshot(spark, rejects), _snapshot(spark, ports)) == before
    # the next month has its columns in another order and brings another member
    row = NAT_ROWS[5].replace("25XX", "26XX").replace(",3,2024", ",4,2024")
    _write(f"{src}/2024-04/dot3_0424.csv", reversed_columns(NAT_HEADER) + "\n" + reversed_columns(row) + "\n")
    load()
    later = {r["port_code"]: r["port_id"] for r in dimension_at(spark, ports).collect()}
    assert members.items() <= later.items() and later[2699] > max(members.values())
    assert spark.read.parquet(out).where(F.col("port_id") == later[2699]).select("date_id").first()[0] == 20240401
    assert "loaded_at" in spark.read.parquet(out).columns


def test_late_readings_are_counted(spark, workdir):
    src = f"{workdir}/in"
    days = [[("2024-03-01 08:00:00", 10.0), ("2024-03-01 09:00:00", 11.01), ("2024-03-02 09:00:00", 4.0)], [("2024-03-09 10:00:00", 7.0)],
            [("2024-03-01 10:00:00", 99.0), ("2024-03-01 11:00:00", 1.5), ("2024-03-09 11:00:00", 8.0), ("2024-03-08 11:00:00", None)]]
    name = "late_" + os.path.basename(workdir)
    schema = "ts string, value double, user long"
    for k, rows in enumerate(days):
        df = spark.createDataFrame([(*r, 5) for r in rows], schema).withColumn("ts", F.col("ts").cast("timestamp"))
        df.coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(df.schema).parquet(src)
        assert write_accounted(daily_wait_accounted(stream, F.col("user"), F.lit(1)), f"{workdir}/out", name) >= 1
    got = {r["date_id"]: (str(r["waiting_avg_minutes"]), r["readings"], r["late_readings"], r["late_cents"]) for r in accounted_days(spark, f"{workdir}/out").collect()}
    assert got == {20240301: ("10.51", 2, 2, 10050), 20240302: ("4.00", 1, 0, 0), 20240309: ("7.50", 2, 0, 0), 20240308: ("None", 0, 0, 0)}


def test_accounted_means_equal_the_batch(spark, workdir):
    os.makedirs(f"{workdir}/events")
    shutil.copy(f"{SF}/events.parquet", f"{workdir}/events/part-0.parquet")
    stream = spark.readStream.schema(spark.read.parquet(f"{workdir}/events").schema).parquet(f"{workdir}/events")
    lanes = {k: catalogs.lane_ids()[v] for k, v in EVENT_TYPE_TO_LANE.items()}
    out = daily_wait_accounted(stream, wait_port_of(F.col("user_id"), Params()), codes.map_values("event_type", lanes))
    write_accounted(out, f"{workdir}/out", "all_" + os.path.basename(workdir))
    got = sorted(tuple(r) for r in accounted_days(spark, f"{workdir}/out").select("port_id", "lane_type_id", "date_id", "waiting_avg_minutes").collect())
    assert got == sorted(tuple(r) for r in model(spark, SF).wait().collect()) and len(got) > 0
