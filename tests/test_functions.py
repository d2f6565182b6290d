from decimal import Decimal

from pyspark.sql import functions as F

from portflow.functions import codes, dates, metrics


def test_parse_port_code(spark):
    df = spark.createDataFrame([("2504",), ("25XX",), ("25xx",), ("",), ("junk",), (None,), ("250",), ("25XY",)], "d string")
    got = [r.c for r in df.select(codes.parse_port_code("d").alias("c")).collect()]
    assert got == [2504, 2599, 2599, None, None, None, None, None]


def test_synthetic_names_and_state(spark):
    df = spark.createDataFrame([(2599,), (2304,), (9905,)], "c int")
    rows = df.select(codes.synthetic_port_name("c").alias("n"),
                     codes.state_of_district(codes.district_of("c")).alias("s")).collect()
    assert [r.n for r in rows] == ["District 25XX residual", "District 23 aggregate (2304)", "District 99 aggregate (9905)"]
    assert [r.s for r in rows] == ["California", "Texas", "Other"]


def test_normalize_text(spark):
    df = spark.createDataFrame([("  Coffee, Tea; MATE &  spices!! ",), ("a--b",)], "t string")
    got = [r.n for r in df.select(codes.normalize_text("t").alias("n")).collect()]
    assert got == ["coffee tea mate spices", "a b"]


def test_map_values_default(spark):
    df = spark.createDataFrame([("0",), ("1",), ("X",), ("Q",), (None,)], "c string")
    got = [r.v for r in df.select(codes.map_values("c", {"0": "Not Containerized", "1": "Containerized",
                                                        "X": "Unknown"}, "Unknown").alias("v")).collect()]
    assert got == ["Not Containerized", "Containerized", "Unknown", "Unknown", "Unknown"]


def test_mean_half_up_exact(spark):
    # 6.175 is not representable in binary; the exact mean rounds half up
    df = spark.createDataFrame([(1235, 2), (100, 3), (0, 0), (5, 1)], "s long, n long")
    got = [r.m for r in df.select(metrics.mean_half_up("s", "n").alias("m")).collect()]
    assert got == [Decimal("6.18"), Decimal("0.33"), None, Decimal("0.05")]


def test_growth_guards(spark):
    df = spark.createDataFrame([(110, 100), (5, 0), (5, None)], "a long, b long")
    got = [r.g for r in df.select(metrics.growth_pct("a", "b").alias("g")).collect()]
    assert got == [10.0, None, None]


def test_date_keys_iso_boundaries(spark):
    df = spark.createDataFrame([("2023-01-01",), ("2024-12-30",), ("2024-02-29",)], "d string") \
        .select(F.col("d").cast("date").alias("d"))
    rows = df.select(dates.date_key("d").alias("k"), dates.iso_week("d").alias("w"), dates.iso_dow("d").alias("dow"),
                     dates.month_key("d").alias("mk")).collect()
    assert [(r.k, r.w, r.dow, r.mk) for r in rows] == [(20230101, 52, 7, 20230101), (20241230, 1, 1, 20241201),
                                                       (20240229, 9, 4, 20240201)]


def test_shift_months_and_tolerant_parse(spark):
    df = spark.createDataFrame([(20241101, "Mar 2024", "2024-03-05T10:00:00"), (20240101, "bad", "nope")],
                               "k int, t string, ts string")
    rows = df.select(dates.shift_month_key("k", -11).alias("s"), dates.shift_month_key("k", -23).alias("p"),
                     dates.parse_month_year("t").alias("m"), dates.parse_iso_timestamp("ts").alias("ts")).collect()
    assert rows[0].s == 20231201 and rows[0].p == 20221201 and str(rows[0].m) == "2024-03-01"
    assert rows[1].s == 20230201 and rows[1].m is None and rows[1].ts is None
