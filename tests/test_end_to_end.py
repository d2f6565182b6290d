"""Raw feeds -> load job -> warehouse -> the eighteen marts."""

import json
import os

from pyspark.sql import functions as F

from portflow.plans import jobs, marts
from portflow.plans.warehouse import warehouse_model
from portflow.sources.testdata import Params

PORTS = [("Otay Mesa", 2506), ("San Ysidro", 2504), ("Tecate", 2505), ("Laredo", 2304)]
MONTHS = [(y, m) for y in range(2019, 2025) for m in range(1, 13)]
HDR = "TRDTYPE,DEPE,COMMODITY2,DISAGMOT,COUNTRY,VALUE,SHIPWT,FREIGHT_CHARGES,DF,CONTCODE,MONTH,YEAR"


def _feeds(d):
    os.makedirs(f"{d}/bc")
    with open(f"{d}/bc/crossing.csv", "w") as f:
        f.write("Port Name,State,Port Code,Border,Date,Measure,Value,Latitude,Longitude\n")
        for i, (name, code) in enumerate(PORTS):
            for y, m in MONTHS:
                mon = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"][m - 1]
                f.write(f"{name},California,{code},US-Mexico Border,{mon} {y},Trucks,{1000 + 10 * i + m + (y - 2019) * 7},32.5,-117.0\n")
                f.write(f"{name},California,{code},US-Mexico Border,{mon} {y},Personal Vehicles,{5000 + m},32.5,-117.0\n")
    for y, m in MONTHS:
        if (y, m) == (2024, 12):
            continue                      # last month comes from the mirror only
        p = f"{d}/nat/{y}-{m:02d}"
        os.makedirs(p)
        rows = []
        for i, (name, code) in enumerate(PORTS + [("residual", "25XX")]):
            for hs, mode in ((84, 5), (9, 6)):
                dip = 0.5 if (y, m) == (2020, 4) else 1.0       # a shock month
                v = int((100000 + 1000 * i + 10 * m + 3000 * (y - 2019)) * dip)
                rows.append(f"2,{code},{hs},{mode},2010,{v},{v // 10},,1.0,1,{m},{y}")
        with open(f"{p}/dot3_{m:02d}{y % 100:02d}.csv", "w") as f:
            f.write(HDR + "\n" + "\n".join(rows) + "\n")
    os.makedirs(f"{d}/mirror")
    json.dump([{"year": "2024", "month": "12", "port_code": "2506", "port_name": "Otay Mesa",
                "mode_of_transportation": "Truck", "commodity": "Coffee, tea, mate and spices", "trade_type": "Import",
                "container": "Containerized", "production_location": None, "value": "250000",
                "shipment_weight": "10", "freight_charge": None}], open(f"{d}/mirror/p0.json", "w"))
    os.makedirs(f"{d}/wait")
    waits = []
    for day in range(1, 29):
        for lane, base in (("Commercial_Standard_Lane", 60), ("Commercial_Fast_Lane", 45)):
            waits.append({"date": f"2024-02-{day:02d}T00:00:00.000", "port_name": "Otay Mesa", "type": lane,
                          "waiting_ave": str(base + day % 7)})
    json.dump(waits, open(f"{d}/wait/p0.json", "w"))
    return jobs.FeedPaths(national=f"{d}/nat/*/*.csv", crossing=f"{d}/bc/crossing.csv",
                          wait=f"{d}/wait/*.json", mirror=f"{d}/mirror/*.json")


def test_feeds_to_marts(spark, workdir):
    counts = jobs.load_feeds(spark, _feeds(workdir), f"{workdir}/wh")
    assert counts["fact_trade"] == 71 * 5 * 2 + 1        # 71 national months x 5 ports x 2 rows + mirror
    root = f"{workdir}/wh"
    ids = {n: jobs.focus_port_id(spark, root, n) for n, _ in PORTS}
    assert ids == {"Laredo": 1, "Otay Mesa": 2, "San Ysidro": 3, "Tecate": 4}
    p = Params(focus_port=ids["Otay Mesa"], corridor_ports=(2, 3, 4), current_year=2024, base_year=2019,
               gap_year=1900, mirror_start="2024-12-01", series_start="2019-01-01", history_start_year=2019,
               unit_scale=1e6, crossing_border="US-Mexico", wait_year=2024, shock_year=2020, recovery_end_year=2023,
               dual_start_year=2019, dual_end_year=2025,
               wait_kpis=((2, "Commercial Standard"), (2, "Commercial Fast"), (3, "POV Standard"), (4, "Commercial Standard")))
    wm = warehouse_model(spark, root, p)
    out = {name: getattr(marts, name)(wm).collect() for name in
           ["mart_meta", "mart_panorama_kpis", "mart_value_timeline", "mart_crossings_timeline", "mart_top_ports",
            "mart_focus_kpis", "mart_focus_monthly", "mart_focus_yearly", "mart_sector_mix", "mart_sector_history",
            "mart_density_ratio", "mart_asymmetry", "mart_wait_kpis", "mart_wait_heatmap", "mart_lane_savings",
            "mart_wait_trend", "mart_recovery_kpis", "mart_dual_series", "mart_density_trend"]}
    assert all(len(v) > 0 for v in out.values())
    k = out["mart_panorama_kpis"][0]
    assert (k.ttm_start, k.ttm_end) == ("2023-12", "2024-11") and k.crossings_year == 2024
    f = out["mart_focus_kpis"][0]
    # the mirror month completes 2024 for the corridor; the national source stops at 2023
    assert (f.corridor_year, f.national_year, f.trucks_year) == (2024, 2023, 2024)
    assert {r.sector for r in out["mart_sector_mix"]} == {"Agro/Alimentos", "Electrónica/Maquinaria"}
    r = out["mart_recovery_kpis"][0]
    assert r.drop_pct < 0 and r.recovery_months == 1
    assert out["mart_lane_savings"][0].avg_saving_pct < 0
    assert len(out["mart_value_timeline"]) == 71 and out["mart_value_timeline"][-1].value_usd is not None
    top = [x.port for x in out["mart_top_ports"]]
    assert "residual" not in " ".join(top) and len(top) == 4
