"""Findings of round 3: what no longer grows with the input in the driver or in a Python worker."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from portflow.operators import profile, windows


@pytest.mark.parametrize("hot", [100_000, 1000])
def test_many_duplicates_are_neither_broadcast_nor_multiplied(spark, monkeypatch, hot):
    """small files of many duplicated keys."""
    monkeypatch.setattr(windows, "HOT_ROWS", hot, raising=False)
    x = spark.range(9000).select(F.when(F.col("id") < 3000, F.lit(None).cast("long")).otherwise(F.floor(F.col("id") / 2)).alias("a"), F.lit("é").alias("b")).repartition(5)
    x = x.unionByName(spark.createDataFrame([(-1, "é"), (None, None)], "a long, b string"))
    marked = windows.dup_mark(x, ["a", "b"], max_rows=10, salts=4)
    plan = marked._jdf.queryExecution().sparkPlan().toString()
    assert "Generate" not in plan and "SortMergeJoin" in plan
    assert plan.count("BroadcastHashJoin") == (hot == 1000)  # the one hot key
    got = {(r["a"], r["b"]): (r["is_dup"], r["count"]) for r in marked.groupBy("a", "b", "is_dup").count().collect()}
    assert got == {(None, "é"): (True, 3000), (-1, "é"): (False, 1), (None, None): (False, 1)} | {(k, "é"): (True, 2) for k in range(1500, 4500)}


def test_value_counts_hold_little(spark, monkeypatch):
    """what a task holds doesn't follow the number of distinct values that it has read."""
    df, taken = spark.range(10).select(F.col("id").alias("a"), F.col("id").alias("b")), []
    whole = type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, fn, *args: taken.append(fn) or whole(self, fn, *args))
    profile.value_counts_long(df, ["a", "b"], profile.T.StringType())
    before, most = pa.total_allocated_bytes(), []

    def batches():
        for k in range(0, 600_000, 10_000):
            values = pa.array([f"a value of some length {v}" for v in range(k, k + 10_000)])
            yield pa.RecordBatch.from_arrays([values, pa.array(["x"] * 10_000)], names=["c0", "c1"])
            most.append(pa.total_allocated_bytes() - before)

    rows = {0: 0, 1: 0}
    for batch in taken[0](batches()):
        assert batch.num_rows <= profile.PASSED_ROWS
        for column, n in zip(batch.column("column").to_pylist(), batch.column("n").to_pylist()):
            rows[column] += n
    assert rows == {0: 600_000, 1: 600_000} and max(most) < 16 << 20
