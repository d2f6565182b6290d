
import datetime as dt
from decimal import Decimal

import pytest

from portflow.plans import marts
from portflow.sources.testdata import Model, Params

SCHEMAS = {
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
}


def _tables(spark, root, **rows):
    base = {"supplier": [(k, f"S{k}", 0, 0.0) for k in range(5)], "nation": [(0, "N0", 0)],
            "region": [(0, "AMERICA")], "part": [(1, "p", "b", "T1", 1, 1.0)],
            "lineitem": [], "orders": [], "events": []}
    base.update(rows)
    for name, data in base.items():
        spark.createDataFrame(data, SCHEMAS[name]).write.mode("overwrite").parquet(f"{root}/{name}.parquet")
    return root


def _ts(y, m, d=1):
    return dt.datetime(y, m, d)


def _li(k, supp, y, m, price, status="F", d=1):
    return (k, 1, supp, 5, 1.0, float(price), 0.0, 0.01, "A", status, _ts(y, m, d))


def _ev(i, user, day, etype, value):
    return (i, dt.datetime(2024, 1, day, 12), user, etype, float(value), '{"k": 1}')


def test_trailing_window_is_n_plus_one_days_and_missing_lane_gives_null_savings(spark, workdir):
    # focus port 1 = user 0; standard lane = 'view'; days 1..10 with value = day
    ev = [_ev(d, 0, d, "view", d) for d in range(1, 11)]
    root = _tables(spark, workdir, events=ev)
    m = Model(spark, root, Params(wait_window_days=7, wait_year=2024))
    k = {(r.port_id, r.lane): r for r in marts.mart_wait_kpis(m).collect()}
    # window [10 - 7, 10] = days 3..10 (8 days): mean 6.5
    assert k[(1, "Commercial Standard")].avg_min == Decimal("6.50")
    assert k[(1, "Commercial Standard")].window_end == "2024-01-10"
    assert k[(1, "Commercial Fast")].avg_min is None
    s = marts.mart_lane_savings(m).first()
    assert s.std_n_days == 10 and s.fast_n_days == 0
    assert s.avg_saving_pct is None and s.p95_saving_pct is None       # one side missing -> NULL, no error


def test_missing_trucks_give_null_ratios(spark, workdir):
    li = [_li(i, 1, y, m, 100 + m) for i, (y, m) in enumerate([(y, m) for y in (1995, 2000) for m in range(1, 13)])]
    # crossings only for the base year: current-year trucks are missing
    orders = [(i, 1, "F", 5000.0, _ts(1995, m), "1-URGENT") for i, m in enumerate(range(1, 13))]
    root = _tables(spark, workdir, lineitem=li, orders=orders)
    m = Model(spark, root, Params(gap_year=1900, mirror_start="2100-01-01"))
    f = marts.mart_focus_kpis(m).first()
    assert f.usd_per_truck is None and f.usd_per_truck_delta_pct is None
    r = marts.mart_density_ratio(m).first()
    assert r.trucks_cur == 0 and r.trucks_growth_pct == -100.0


def test_recovery_counts_rows_and_last_complete_year_skips_gaps(spark, workdir):
    vals = {(1995, m): 120 for m in range(1, 13)}                        # base monthly average 120
    series = [(1998, 1, 100), (1998, 2, 40), (1998, 3, 90), (1998, 5, 40), (1998, 7, 130)]   # gaps in Apr, Jun
    vals.update({(y, mo): v for y, mo, v in series})
    li = [_li(i, 1, y, m, v) for i, ((y, m), v) in enumerate(sorted(vals.items()))]
    root = _tables(spark, workdir, lineitem=li)
    m = Model(spark, root, Params(gap_year=1900, mirror_start="2100-01-01", base_year=1995, shock_year=1998,
                                  recovery_end_year=1998, current_year=1998))
    r = marts.mart_recovery_kpis(m).first()
    # worst month = Feb (earliest of the two 40s); first month >= 120 is Jul: rows Feb->Mar->May->Jul = 3
    assert r.recovery_months == 3
    assert r.drop_pct == pytest.approx(round((40 - 120) / 120 * 100, 2))
    y = {row.year: row for row in marts.mart_focus_yearly(m).collect()}
    assert y[1995].complete and not y[1998].complete and y[1998].last_complete_year == 1995
