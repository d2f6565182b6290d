"""Order statistics, distinct counts, duplicate marks and grids: results by hand, and plans without hot tasks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from portflow.operators import profile, series, windows
from portflow.plans import marts, warehouse
from portflow.sources.testdata import model

SF = "/root/testdata/sf0.01"


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    """One value holds most rows of a column, another column is all distinct, a third has text and nulls."""
    x = spark.range(20_000).repartition(7)
    return x.select("id", F.when(F.col("id") % 10 < 7, 5.0).otherwise(F.col("id") / 7).alias("hot"),
                    F.when(F.col("id") % 3 > 0, F.repeat(F.lit("é"), F.pmod("id", F.lit(11)).cast("int"))).alias("text"), F.lit(None).cast("int").alias("none"))


def test_describe_is_exact(skewed):
    got = {r["column"]: r for r in profile.describe(skewed, ["id", "hot", "text", "none"]).collect()}
    rows = skewed.collect()
    columns = {"id": [r["id"] for r in rows], "hot": [r["hot"] for r in rows], "text": [len(r["text"]) for r in rows if r["text"] is not None]}
    for c, values in columns.items():
        r = got[c]
        assert r["count"] == len(values) and (r["min"], r["max"]) == (min(values), max(values))
        assert np.allclose([r["mean"], r["std"]], [np.mean(values), np.std(values, ddof=1)])
        assert np.allclose([r["p25"], r["p50"], r["p75"]], np.quantile(values, [0.25, 0.5, 0.75]))
    assert (got["none"]["count"], got["none"]["p50"], got["none"]["min"]) == (0, None, None)
    rough = {r["column"]: r for r in profile.describe(skewed, ["id"], exact=False).collect()}["id"]
    assert abs(rough["p50"] - 10_000) < 100


def test_no_task_gets_a_column(spark, skewed):
    counts = profile.value_counts_long(skewed, ["id", "hot"], profile.T.DoubleType())
    assert "Expand" not in plan_of(counts) and "Generate" not in plan_of(counts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = profile.ranked_counts(counts)
        assert "Window" in plan_of(ranked)   # over the partitions' totals alone, which come from an aggregate
        below = plan_of(ranked).split("Window", 1)[1]
        assert "Aggregate" in below.split("Relation", 1)[0]
        per_part = ranked.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert ranked.count() == 20_000 + skewed.select("hot").distinct().count() and len(per_part) >= 1
    assert ranked.where("column = 'id' AND last <> value").count() == 0


def test_distinct_counts_without_expanded_rows(spark, skewed, monkeypatch):
    monkeypatch.setattr(profile, "HELD_VALUES", 1000)
    df = skewed.withColumn("zero", F.when(F.col("id") % 2 == 0, 0.0).otherwise(-0.0))
    found = profile.profile_distinct(df, ["id", "hot", "text", "none", "zero"])
    assert "Expand" not in plan_of(found) and "Generate" not in plan_of(found)
    want = df.agg(*[F.countDistinct(c).alias(c) for c in ("id", "hot", "text", "none", "zero")]).first()
    assert {r["column"]: r["n_distinct"] for r in found.collect()} == want.asDict()


@pytest.mark.parametrize("bound", [1000, 0])
def test_hot_key_marks(spark, bound):
    x = spark.range(9000).select(F.when(F.col("id") < 3000, F.lit(None).cast("long")).when(F.col("id") < 3010, 7).otherwise(F.col("id")).alias("a"), (F.col("id") % 2).alias("b")).repartition(5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    marked = windows.dup_mark(x, ["a", "b"], max_rows=bound, salts=4)
    got = {(r["a"], r["is_dup"]): r["count"] for r in marked.where("a IS NULL OR a < 3020").groupBy("a", "is_dup").count().collect()}
    assert got == {(None, True): 3000, (7, True): 10} | {(k, False): 1 for k in range(3010, 3020)}
    assert marked.count() == 9000 and marked.columns == ["a", "b", "is_dup"]
    plan = marked._jdf.queryExecution().sparkPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert ("BroadcastHashJoin" in plan) == (bound > 0)


def test_wide_grid(spark, monkeypatch):
    cells = spark.range(0, 100_000).select((F.col("id") % 3).alias("r"), F.col("id").alias("c"), (F.col("id") + 1).alias("v"))
    grid = series.grid_zero_fill(cells, "r", "c", "v")
    assert "Window" not in plan_of(grid)
    got = grid.agg(F.count("*").alias("n"), F.sum("v").alias("v"), F.count_if(F.col("v") == 0).alias("zeros")).first()
    assert tuple(got) == (300_000, 100_000 * 100_001 // 2, 200_000)


def test_small_grid_with_nulls(spark):
    cells = spark.createDataFrame([("a", 1, 5), ("a", None, 6), (None, 1, 7)], "r string, c int, v int")
    got = sorted((tuple(x) for x in series.grid_zero_fill(cells, "r", "c", "v", "n").collect()), key=str)
    assert got == sorted([("a", 1, 5), ("a", None, 6), (None, 1, 7), (None, None, 0)], key=str)
    assert series.grid_zero_fill(cells.limit(0), "r", "c", "v").collect() == []


def scan_metrics(df):
    """Metrics of the scans of an executed plan."""
    out = []

    def walk(p):
        if p.nodeName().startswith("Scan"):
            it, own = p.metrics().iterator(), {}
            while it.hasNext():
                pair = it.next()
                own[pair._1()] = pair._2().value()
            out.append(own)
        for k in range(p.children().size()):
            walk(p.children().apply(k))
        if p.nodeName().startswith("AdaptiveSparkPlan"):
            walk(p.executedPlan())
        elif "QueryStage" in p.nodeName():
            walk(p.plan())

    df.collect()
    walk(df._jdf.queryExecution().executedPlan())
    return out


def test_one_year_of_partitions_is_read(spark, workdir):
    m = model(spark, SF)
    w = warehouse.warehouse_model(spark, warehouse.build_warehouse(m, f"{workdir}/wh"))
    (scan,) = [x for x in scan_metrics(w.trade_in_year(marts._last_year(w))) if "numPartitions" in x]
    assert scan["numPartitions"] <= 24 < 80 < scan["staticFilesNum"] and scan["numFiles"] < scan["staticFilesNum"] / 3
    year = marts._last_year(m).first()["year"]
    lo, hi = year * 10000 + 101, year * 10000 + 1231
    same = m.trade().where(F.col("date_id").between(lo, hi))
    one = m.trade_in_year(marts._last_year(m))
    assert one.exceptAll(same).count() == 0 == same.exceptAll(one).count()
    scans = [x for x in one._jdf.queryExecution().sparkPlan().toString().splitlines() if "FileScan" in x and "lineitem" in x]
    assert any("l_shipdate" in x.split("DataFilters", 1)[1].split("Format")[0] and "scalar-subquery" in x for x in scans)
