"""Loads by name, rejects of bad required values, null months, percentiles of any type, whole facts."""

import os

import pytest
from pyspark.sql import functions as F

from portflow import schemas
from portflow.operators import aggregates, series
from portflow.operators.windows import share_of_total
from portflow.plans import loads
from portflow.sinks import write_full_refresh
from portflow.sources import files
from portflow.sources.testdata import Params, model, port_code_of

SF = "/root/testdata/sf0.001"
NAMES = [f.name for f in schemas.NATIONAL_CSV.fields]


def _national(workdir, rows, order=None):
    order = order or NAMES
    path = f"{workdir}/dot3_{len(os.listdir(workdir)) + 1:02d}24.csv"
    with open(path, "w") as f:
        f.write(",".join(order) + "\n")
        for r in rows:
            f.write(",".join(str(r.get(c, "")) for c in order) + "\n")
    return path


ROW = {"TRDTYPE": 1, "DEPE": "2501", "COMMODITY2": 87, "DISAGMOT": 5, "COUNTRY": 2010, "VALUE": 100, "SHIPWT": 7, "DF": 1, "CONTCODE": "1", "MONTH": 3, "YEAR": 2024}


def test_columns_are_taken_by_name(spark, workdir):
    _national(workdir, [ROW])
    _national(workdir, [ROW], list(reversed(NAMES)))
    raw = files.read_csv_by_name(spark, f"{workdir}/*.csv", schemas.NATIONAL_CSV)
    assert {(r["VALUE"], r["SHIPWT"], r["DEPE"]) for r in raw.collect()} == {(100, 7, "2501")} and raw.count() == 2


def test_bad_required_values_are_rejected(spark, workdir):
    _national(workdir, [ROW, ROW | {"VALUE": "junk"}, ROW | {"MONTH": "x"}, ROW | {"MONTH": 13}])
    raw = files.read_csv_by_name(spark, f"{workdir}/*.csv", schemas.NATIONAL_CSV)
    d = loads.Dims(port=spark.createDataFrame([(1, 2501, "A"), (2, 2501, "B")], "port_id long, port_code int, port_canonical_name string"),
                   mode=spark.createDataFrame([(k + 1, m) for k, m in enumerate(("Truck", "Rail", "Pedestrian"))], "mode_id int, mode_canonical_name string"),
                   commodity=spark.createDataFrame([(1, 87)], "commodity_id int, hs2_code int"), lane=spark.createDataFrame([], "lane_type_id int, lane_canonical_name string"))
    acc, rej = loads.conform_national(raw, d)
    assert [(r["value_usd"], r["date_id"], r["port_id"]) for r in acc.collect()] == [(100, 20240301, 1)]
    reasons = sorted(x for r in rej.collect() for x in r["reject_reasons"])
    assert reasons == ["bad_date", "bad_date", "bad_value"]


def test_gapfill_ignores_a_null_month(spark):
    df = spark.sql("SELECT CAST(m AS DATE) AS month_date, v FROM VALUES ('2024-01-01', 1), ('2024-03-01', 3), (NULL, 9) AS t(m, v)")
    got = [(str(r[0]), r[1]) for r in series.gapfill_months(df, "month_date", ["v"], "2024-01-01").collect()]
    assert got == [("2024-01-01", 1), ("2024-02-01", None), ("2024-03-01", 3)]


@pytest.mark.parametrize("kind,values,want", [
    ("double", [0.00001, 0.00002, 0.00003], (0.000015, 0.00002)), ("double", [1e15, 3e15, 5e15], (2e15, 3e15)),
    ("decimal(20,8)", ["0.00000010", "0.00000030"], (0.00000015, 0.0000002)), ("long", [10 ** 15, 3 * 10 ** 15], (1.5e15, 2e15))])
def test_percentiles_keep_the_values_type(spark, kind, values, want):
    df = spark.createDataFrame([(str(v),) for v in values], "v string").select(F.col("v").cast(kind).alias("v"))
    got = aggregates.percentile_exact(df, [], "v", [0.25, 0.5], ["a", "b"], digits=9).first()
    assert (got["a"], got["b"]) == pytest.approx(want, rel=1e-9, abs=1e-12)


def test_every_lineitem_is_a_trade_row(spark):
    m = model(spark, SF)
    n = m.table("lineitem").count()
    assert m.trade().count() == n and m.trade_feed().where("port_id is null").count() == 0
    assert m.trade_with_gap().where(F.col("date_id").between(*(Params().gap_year * 10000 + x for x in (101, 1231)))).count() == 0 < n
    ports = m.dim_port().select("port_id")
    assert all(f.join(ports, "port_id", "left_anti").count() == 0 for f in (m.trade(), m.crossing(), m.wait()))


def test_port_codes_hold_at_any_number_of_suppliers(spark):
    ids = spark.range(1, 1_000_001)
    for base in (2000, 5000):
        got = ids.select(port_code_of(F.col("id"), base).alias("c")).agg(F.min("c"), F.max("c"), F.countDistinct("c")).first()
        assert tuple(got) == (base, base + 2999, 3000)
    assert spark.range(1, 2).select(port_code_of(F.col("id"), 2000)).first()[0] == 2001


def test_share_of_all_rows_plans_no_window(spark):
    out = share_of_total(spark.createDataFrame([(1, 30.0), (2, 10.0)], "k int, v double"), "v", "pct")
    assert {r["k"]: r["pct"] for r in out.collect()} == {1: 75.0, 2: 25.0}
    assert "Window" not in out._jdf.queryExecution().toString()


def test_partition_values_are_split_over_files(spark, workdir):
    write_full_refresh(spark.range(1000).selectExpr("id", "1 AS part"), f"{workdir}/t", ["part"])
    assert spark.read.parquet(f"{workdir}/t").count() == 1000
