"""Load jobs on small raw feeds built in the test (FIXTURES.md F-1 .. F-9)."""

import io
import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from portflow import catalogs, schemas
from portflow.plans import loads
from portflow.sinks import to_document, write_full_refresh, write_source_partitions
from portflow.sources import archives, files

NAT_HEADER = "TRDTYPE,DEPE,COMMODITY2,DISAGMOT,COUNTRY,VALUE,SHIPWT,FREIGHT_CHARGES,DF,CONTCODE,MONTH,YEAR"


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def _dims(spark):
    port = spark.createDataFrame(
        [(1, 2504, "Otay Mesa", True, False), (2, 2501, "San Ysidro", True, False), (3, 2302, "Laredo", False, False)],
        "port_id long, port_code int, port_canonical_name string, is_in_corridor boolean, is_aggregate boolean")
    mode = spark.createDataFrame([(i + 1, n) for i, (n, _) in enumerate(catalogs.CANONICAL_MODES)],
                                 "mode_id int, mode_canonical_name string")
    com = spark.createDataFrame([(1, 84, "Nuclear reactors, boilers, machinery and mechanical appliances; parts thereof"),
                                 (2, 9, "Coffee, tea, mate and spices")],
                                "commodity_id int, hs2_code int, hs2_description_full string")
    lane = spark.createDataFrame([(i + 1, n) for i, (n, _, _) in enumerate(catalogs.LANE_TYPES)],
                                 "lane_type_id int, lane_canonical_name string")
    return loads.Dims(port=port, mode=mode, commodity=com, lane=lane)


NAT_ROWS = [
    # duplicate PK, one NULL weight -> summed, weight kept
    "2,2504,84,5,2010,100,10,,1.0,1,3,2024",
    "2,2504,84,5,2010,50,,,1.0,1,3,2024",
    # duplicate PK, all NULL weights -> weight stays NULL
    "2,2501,9,5,2010,7,,,,X,3,2024",
    "2,2501,9,5,2010,3,,,,X,3,2024",
    # export with zero weight -> NULL weight
    "1,2302,84,6,2010,20,0,5,2.0,0,3,2024",
    # residual code (not in the dimension) -> rejected for port
    "2,25XX,84,5,2010,9,1,,1.0,1,3,2024",
    # unknown numeric port, unknown commodity, unknown mode, unknown trade type
    "2,9999,84,5,2010,1,1,,1.0,1,3,2024",
    "2,2504,77,5,2010,1,1,,1.0,1,3,2024",
    "2,2504,84,0,2010,1,1,,1.0,1,3,2024",
    "3,2504,84,5,2010,1,1,,1.0,1,3,2024",
    # other country -> filtered out before mapping
    "2,2504,84,5,1220,1000,1,,1.0,1,3,2024",
    # empty port code -> rejected
    "2,,84,5,2010,2,1,,1.0,Q,3,2024",
]


def test_national_load_rejects_nullify_dedup(spark, workdir):
    _write(f"{workdir}/2024-03/dot3_0324.csv", NAT_HEADER + "\n" + "\n".join(NAT_ROWS) + "\n")
    raw = files.read_csv(spark, f"{workdir}/*/dot3_*.csv", schemas.NATIONAL_CSV)
    assert raw.count() == len(NAT_ROWS)
    fact, rej = loads.conform_national(raw, _dims(spark))
    # accepted + rejected = rows in scope (country filter removed one)
    assert fact.count() + rej.count() == len(NAT_ROWS) - 1
    reasons = {r.reason: r.n for r in __import__("portflow.operators.conform", fromlist=["x"]).reject_counts(rej).collect()}
    assert reasons == {"port_unmapped": 3, "commodity_unmapped": 1, "mode_unmapped": 1, "direction_unmapped": 1}
    out = loads.collapse_trade_duplicates(fact)
    got = {(r.port_id, r.commodity_id): (r.value_usd, r.weight_kg, r.container, r.production_location)
           for r in out.collect()}
    assert got[(1, 1)] == (150, 10, "Containerized", "Domestically Produced Goods")
    assert got[(2, 2)] == (10, None, "Unknown", "N/A")
    assert got[(3, 1)] == (20, None, "Not Containerized", "Foreign Produced Goods")
    # sum before collapse = sum after
    assert fact.agg(F.sum("value_usd")).first()[0] == out.agg(F.sum("value_usd")).first()[0]


def test_file_period_rules(spark):
    names = ["/x/2024-03/dot3_0324.csv", "/x/dot3_2009.csv", "/x/dot3_ytd_0317.csv", "/x/DOT3_0107.CSV",
             "/x/dot3_0105.csv", "/x/dot3_1331.csv"]
    df = spark.createDataFrame([(n,) for n in names], "f string")
    got = [r.p for r in df.select(files.national_file_period("f").alias("p")).collect()]
    assert got == ["2024-03", None, None, "2007-01", None, None]


def test_mirror_load_and_policies(spark, workdir):
    page = [
        {"year": "2024", "month": "12", "port_code": "2504", "port_name": "Otay Mesa", "mode_of_transportation": "Truck",
         "commodity": "COFFEE, TEA, MATE AND SPICES", "trade_type": "Import", "container": None,
         "production_location": None, "value": "120", "shipment_weight": "0", "freight_charge": "abc"},
        {"year": "2024", "month": "12", "port_code": "25XX", "port_name": "x", "mode_of_transportation": "Truck",
         "commodity": "Coffee; tea, mate & spices", "trade_type": "Export", "container": "Containerized",
         "production_location": "N/A", "value": "5", "shipment_weight": "0", "freight_charge": "1"},
    ]
    _write(f"{workdir}/mirror/page_0.json", json.dumps(page))
    raw = files.read_json_pages(spark, f"{workdir}/mirror/*.json", schemas.MIRROR_JSON)
    fact, rej = loads.conform_mirror(raw, _dims(spark))
    rows = fact.collect()
    assert len(rows) == 1 and rej.count() == 1
    r = rows[0]
    assert (r.commodity_id, r.container, r.production_location, r.weight_kg, r.freight_charge_usd, r.data_source) == \
        (2, "Unknown", "N/A", 0, None, "mirror")
    loads.assert_no_duplicates(fact)
    with pytest.raises(loads.LoadAborted):
        loads.assert_no_duplicates(fact.unionByName(fact))
    national = spark.createDataFrame([(20241201,)], "date_id int")
    with pytest.raises(loads.LoadAborted):
        loads.assert_no_overlap(national, fact)


def test_crossing_and_port_dimension(spark, workdir):
    hdr = "Port Name,State,Port Code,Border,Date,Measure,Value,Latitude,Longitude"
    rows = ["Otay Mesa,California,2506,US-Mexico Border,Mar 2024,Trucks,100,32.5,-117.0",
            "Otay Mesa,California,2506,US-Mexico Border,Mar 2024,Trucks,5,32.5,-117.0",      # duplicate PK -> summed
            "Otay Mesa,California,2506,US-Mexico Border,Feb 2024,Buses,7,32.4,-116.9",       # older coordinates
            "Otay Mesa,California,2506,US-Mexico Border,Marzo 2024,Trucks,1,,",              # bad date
            "Derby Line,Vermont,209,US-Canada Border,Mar 2024,Trucks,9,,",                  # other border
            "Cross Border Xpress,California,2507,US-Mexico Border,Mar 2024,Pedestrians,3,,",  # excluded
            "Tecate,California,2505,US-Mexico Border,Mar 2024,Llamas,3,,",                  # unknown measure
            ",California,2599,US-Mexico Border,Mar 2024,Trucks,4,,"]                       # NULL port name
    _write(f"{workdir}/bc/crossing.csv", hdr + "\n" + "\n".join(rows) + "\n")
    raw = files.read_csv(spark, f"{workdir}/bc/crossing.csv", schemas.CROSSING_CSV)
    port = loads.build_port_dimension(raw)
    ports = {r.port_canonical_name: r for r in port.collect()}
    assert set(ports) == {"Otay Mesa", "Tecate"}
    assert float(ports["Otay Mesa"].latitude) == 32.5 and ports["Otay Mesa"].is_in_corridor
    assert ports["Otay Mesa"].port_id == 1 and ports["Tecate"].port_id == 2
    d = _dims(spark)
    d.port = port
    fact, rej = loads.conform_crossing(raw, d)
    got = {(r.mode_id, r.date_id): r.crossing_count for r in fact.collect()}
    truck, bus = catalogs.mode_ids()["Truck"], catalogs.mode_ids()["Bus"]
    assert got == {(truck, 20240301): 105, (bus, 20240201): 7}
    assert rej.count() == 3   # bad date, unknown measure, NULL port name


def test_wait_load_rounds_and_averages(spark, workdir):
    page = [{"date": "2024-03-01T00:00:00.000", "port_name": "Otay Mesa", "type": "Commercial_Standard_Lane", "waiting_ave": "10.125"},
            {"date": "2024-03-01T00:00:00.000", "port_name": "Otay Mesa", "type": "Commercial_Standard_Lane", "waiting_ave": "11"},
            {"date": "2024-03-02T00:00:00.000", "port_name": "Otay Mesa", "type": "Hover_Lane", "waiting_ave": "3"},
            {"date": "not a date", "port_name": "Otay Mesa", "type": "Commercial_Fast_Lane", "waiting_ave": "3"},
            {"date": "2024-03-02T00:00:00.000", "port_name": "Calexico_West", "type": "Commercial_Fast_Lane", "waiting_ave": "2.5"}]
    _write(f"{workdir}/wait/p0.json", json.dumps(page))
    raw = files.read_json_pages(spark, f"{workdir}/wait/*.json", schemas.WAIT_JSON)
    fact, rej = loads.conform_wait(raw, _dims(spark))
    rows = fact.collect()
    assert len(rows) == 1 and str(rows[0].waiting_avg_minutes) == "10.56"   # (10.12 + 11) / 2 = 10.56
    assert rej.count() == 3


def test_code_lookup_ignores_meta(spark, workdir):
    _write(f"{workdir}/lookup.json", json.dumps({"_meta": {"source": "x", "note": "y"}, "1": "Vessel", "5": "Truck"}))
    got = {r.code: r.label for r in files.read_code_lookup(spark, f"{workdir}/lookup.json").collect()}
    assert got == {"1": "Vessel", "5": "Truck"}


def _zip(entries):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for name, data in entries:
            z.writestr(name, data)
    return buf.getvalue()


def test_archive_expansion(spark, workdir):
    csv = NAT_HEADER + "\n" + NAT_ROWS[0] + "\n" + NAT_ROWS[2] + "\n"
    monthly = _zip([("dot3_0324.csv", csv), ("readme.txt", "x")])
    inner = _zip([("dot3_0424.csv", csv)])
    yearly = _zip([("2024/inner_04.zip", inner), ("dot3_ytd_0424.csv", csv)])
    d = f"{workdir}/zips"
    os.makedirs(d)
    open(f"{d}/2024_03.zip", "wb").write(monthly)
    open(f"{d}/2024_year.zip", "wb").write(yearly)
    open(f"{d}/2024_trunc.zip", "wb").write(monthly[: len(monthly) // 2])
    lines = archives.expand_archives(spark, f"{d}/*.zip")
    rows = lines.where("status = 'ok' AND line_no > 0").select("member", "period").collect()
    periods = sorted({r.period for r in rows if r.period})
    assert periods == ["2024-03", "2024-04"]
    bad = lines.where("status <> 'ok'").count()
    assert bad == 1
    report = archives.member_report(archives.member_directory(spark, f"{d}/*.zip"))
    parsed = archives.read_archived_csv(archives.first_copies(report), schemas.NATIONAL_CSV)
    vals = sorted((r.DEPE, r.VALUE) for r in parsed.collect())
    assert vals == [("2501", 7), ("2501", 7), ("2504", 100), ("2504", 100)]
    rep = {r.archive.rsplit("/", 1)[-1]: r for r in archives.archive_report(report).collect()}
    assert rep["2024_trunc.zip"].members_damaged == 1 and rep["2024_03.zip"].members_ok == 1


def test_archive_damage_of_every_kind(spark, workdir):
    """Encrypted, corrupt and unknown-method members give a row each; members out of scope are never opened."""
    csv = "A,B\n" + "".join(f"{k},{k * 7919 % 1009}\n" for k in range(2000))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for name in ("good.csv", "crypt.csv", "method.csv", "corrupt.csv", "notes.pdf"):
            z.writestr(name, csv)
        z.writestr("none.csv", "")
    with zipfile.ZipFile(buf) as z:
        start = {i.filename: i.header_offset for i in z.infolist()}
    data = bytearray(buf.getvalue())
    central = data.index(b"PK\x01\x02")

    def mark(name, flags=None, method=None):
        for at, flag, how in ((start[name], 6, 8), (data.index(b"PK\x01\x02", data.rindex(name.encode(), central) - 46), 8, 10)):
            if flags is not None:
                data[at + flag] |= flags
            if method is not None:
                data[at + how] = method

    mark("crypt.csv", flags=1)
    mark("notes.pdf", flags=1)
    mark("method.csv", method=99)
    body = start["corrupt.csv"] + 30 + len("corrupt.csv")
    data[body:body + 200] = b"\xff" * 200
    os.makedirs(f"{workdir}/zips")
    with open(f"{workdir}/zips/mixed.zip", "wb") as f:
        f.write(data)
    lines = archives.expand_archives(spark, f"{workdir}/zips/*.zip")
    got = {r.member: (r.status, r.n) for r in lines.groupBy("member", "status").agg(F.count("line").alias("n")).collect()}
    assert got == {"good.csv": ("ok", 2001), "crypt.csv": ("damaged", 0), "method.csv": ("damaged", 0), "corrupt.csv": ("damaged", 0),
                   "none.csv": ("ok", 0)}


def test_sinks_idempotent_and_json_nulls(spark, workdir):
    df = spark.createDataFrame([("national", 20240101, 1), ("national", 20240201, 2), ("mirror", 20241201, 3)],
                               "data_source string, date_id int, v long")
    out = f"{workdir}/fact"
    write_full_refresh(df, out, ["data_source"])
    fresh = spark.createDataFrame([("mirror", 20241201, 30)], "data_source string, date_id int, v long")
    write_source_partitions(fresh, out, ["data_source"])
    write_source_partitions(fresh, out, ["data_source"])       # re-run changes nothing
    got = sorted((r.data_source, r.v) for r in spark.read.parquet(out).collect())
    assert got == [("mirror", 30), ("national", 1), ("national", 2)]
    doc = to_document(spark.createDataFrame([(1, None)], "a int, b string")).first().value
    assert json.loads(doc) == {"data": [{"a": 1, "b": None}]}


def test_scan_csv_glob_concat_by_name(spark, workdir):
    """Two eras with different column orders (and one missing column) are
    concatenated by name, not by position."""
    _write(f"{workdir}/a/dot3_0124.csv", NAT_HEADER + "\n" + NAT_ROWS[0] + "\n")
    cols = NAT_HEADER.split(",")
    vals = NAT_ROWS[2].split(",")
    order = list(reversed(range(len(cols))))
    keep = [i for i in order if cols[i] != "FREIGHT_CHARGES"]
    _write(f"{workdir}/b/dot3_0224.csv", ",".join(cols[i] for i in keep) + "\n" + ",".join(vals[i] for i in keep) + "\n")
    df = files.read_csv_by_name(spark, [f"{workdir}/a/*.csv", f"{workdir}/b/*.csv"], schemas.NATIONAL_CSV)
    got = sorted((r.DEPE, r.VALUE, r.FREIGHT_CHARGES, r.YEAR) for r in df.collect())
    assert got == [("2501", 7, None, 2024), ("2504", 100, None, 2024)]
    assert df.where(F.col("_file").endswith("dot3_0224.csv")).count() == 1


def test_export_documents_keep_nulls(spark, workdir):
    import glob
    from portflow.plans.documents import export_documents
    from portflow.sources.testdata import Params, model
    early = Params(series_start="1990-01-01")                               # two years before the first month
    names = export_documents(model(spark, "/root/testdata/sf0.001", early), f"{workdir}/docs",
                             ["mart_value_timeline", "heatmap_matrix", "mart_wait_kpis"])
    docs = {}
    for n in names:
        (path,) = [p for p in glob.glob(f"{workdir}/docs/{n}/part-*") if not p.endswith(".crc")]
        docs[n] = json.loads(open(path).read())["data"]
    timeline = docs["mart_value_timeline"]
    gap = [r for r in timeline if r["month_date"].startswith("1990-")]
    assert len(gap) == 12 and all(r["value_usd"] is None for r in gap)     # months without rows stay null
    assert all(len(r["week_values"]) == 7 for r in docs["heatmap_matrix"])
    assert all(r["avg_min"] is not None for r in docs["mart_wait_kpis"])    # every KPI port has events
