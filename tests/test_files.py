"""Header discovery, CSV by name, and archives read member by member."""

import io
import os
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from portflow import schemas
from portflow.sources import archives, files, ranged

from tests.test_loads import NAT_HEADER, NAT_ROWS, _write, _zip

COLS = NAT_HEADER.split(",")


class Counting(io.BytesIO):
    asked = 0

    def read(self, size=-1):
        out = super().read(size)
        self.asked += len(out)
        return out


def test_header_costs_one_small_read(spark, workdir, monkeypatch):
    text = (NAT_HEADER + "\n" + (NAT_ROWS[0] + "\n") * 200_000).encode()
    assert len(text) > 7e6
    counting = Counting(text)
    assert ranged.first_line(counting).decode() == NAT_HEADER and counting.asked <= 1 << 16
    os.makedirs(f"{workdir}/big")
    for k in range(3):
        with open(f"{workdir}/big/f {k}.csv", "wb") as f:
            f.write(text)
    want = sorted(f"f%20{k}.csv" for k in range(3))

    def told():
        rows = files.csv_headers(spark, f"{workdir}/big/*.csv").collect()
        assert {r["header"] for r in rows} == {NAT_HEADER}
        return sorted(r["file"].rsplit("/", 1)[-1] for r in rows)

    assert told() == want
    # through Spark's readers: the bytes they have read are known
    monkeypatch.setattr(ranged, "SCHEMES", ("hdfs",))
    read = lambda: sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())
    before = read()
    assert told() == want and read() - before < len(text) / 4


def test_first_line_of_odd_files():
    assert ranged.first_line(io.BytesIO(b"")) == b"" == ranged.first_line(io.BytesIO(b"\r\n \n"))
    assert ranged.first_line(io.BytesIO(b"\n\nA,B"), 2) == b"A,B" == ranged.first_line(io.BytesIO(b"A,B\r\nC"), 3)


def test_ten_header_layouts_in_one_scan(spark, workdir):
    base = dict(zip(COLS, NAT_ROWS[0].split(",")))
    layouts = [COLS, COLS[::-1], COLS[3:] + COLS[:3], [c for c in COLS if c != "FREIGHT_CHARGES"], [c.lower() for c in COLS], [f'"{c}"' for c in COLS], ["EXTRA", *COLS],
               [*COLS, "VALUE"], ["\ufeff" + COLS[0], *COLS[1:]], [f" {c} " for c in COLS]]
    for k, layout in enumerate(layouts):
        seen = set()
        values = []
        for c in layout:
            name = c.strip("\ufeff\" ").upper()
            values.append("zzz" if name in seen or name == "EXTRA" else str(1000 + k) if name == "VALUE" else base[name])
            seen.add(name)
        _write(f"{workdir}/l/f{k}.csv", ("\n" if k == 4 else "") + ",".join(layout) + "\n" + ",".join(values) + "\n")
    _write(f"{workdir}/l/empty.csv", "")
    _write(f"{workdir}/l/header_only.csv", NAT_HEADER + "\n")
    df = files.read_csv_by_name(spark, f"{workdir}/l/*.csv", schemas.NATIONAL_CSV)
    got = {r["VALUE"]: r for r in df.collect()}
    assert sorted(got) == [1000 + k for k in range(10)]
    assert {(r["DEPE"], r["TRDTYPE"], r["DISAGMOT"], r["CONTCODE"], r["YEAR"]) for r in got.values()} == {("2504", 2, 5, "1", 2024)}
    assert got[1003]["FREIGHT_CHARGES"] is None and got[1002]["_file"].endswith("/f2.csv")
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan csv") == 1 and "Scan text" not in plan


def test_values_that_do_not_parse_are_null(spark, workdir):
    _write(f"{workdir}/v/a.csv", "VALUE,DEPE,YEAR\n12.5,0404, 2024 \nabc,25XX\n7,2504,2024,extra\n")
    rows = files.read_csv_by_name(spark, f"{workdir}/v/a.csv", schemas.NATIONAL_CSV).select("VALUE", "DEPE", "YEAR").orderBy(F.col("DEPE")).collect()
    assert [tuple(r) for r in rows] == [(None, "0404", 2024), (7, "2504", 2024), (None, "25XX", None)]


def _archive(path, entries, method=zipfile.ZIP_DEFLATED):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with zipfile.ZipFile(path, "w", method) as z:
        for name, data in entries:
            z.writestr(name, data)


def _month(k, rows=3, value=None):
    return NAT_HEADER + "\n" + "".join(f"2,2504,84,5,2010,{value or k},10,,1.0,1,{k},2024\n" for _ in range(rows))


def test_one_archive_is_read_by_many_tasks(spark, workdir):
    _archive(f"{workdir}/z/year.zip", [(f"dot3_{k:02d}24.csv", _month(k)) for k in range(1, 13)] + [("notes.txt", "x" * 10)])
    directory = archives.member_directory(spark, f"{workdir}/z/*.zip")
    assert directory.count() == 12
    lines = archives.member_lines(archives.member_report(directory))
    assert lines.select(F.spark_partition_id()).distinct().count() >= 6 and lines.count() == 12 * 4


def test_first_sound_copy_of_a_month_counts(spark, workdir):
    d = f"{workdir}/z"
    inner = _zip([("dot3_0424.csv", _month(4)), ("dot3_ytd_0424.csv", _month(4))])
    _archive(f"{d}/2024_a.zip", [("dot3_0124.csv", _month(1, value=11)), ("dot3_0224.csv", _month(2, value=21)), ("x/inner.zip", inner)])
    _archive(f"{d}/2024_b.zip", [("dot3_0124.csv", _month(1, value=12)), ("dot3_0224.csv", _month(2, value=22)), ("DOT3_0324.CSV", _month(3, 1)), ("dot3_0524.csv", ",".join(COLS[::-1]) + "\n" + ",".join(NAT_ROWS[0].split(",")[::-1]))])
    _archive(f"{d}/2024_c.zip", [("stored.zip", _zip([("dot3_0624.csv", _month(6))])), ("dot3_2009.csv", _month(9))], zipfile.ZIP_STORED)
    data = bytearray(open(f"{d}/2024_a.zip", "rb").read())
    with zipfile.ZipFile(f"{d}/2024_a.zip") as z:
        at = z.getinfo("dot3_0224.csv").header_offset + 30 + len("dot3_0224.csv")
    data[at + 5] ^= 255
    open(f"{d}/2024_a.zip", "wb").write(data)
    report = archives.member_report(archives.member_directory(spark, f"{d}/*.zip"))
    first = archives.first_copies(report)
    got = {(r["_file"].rsplit("/", 1)[-1].lower(), r["VALUE"]): r["n"] for r in archives.read_archived_csv(first, schemas.NATIONAL_CSV).groupBy("_file", "VALUE").agg(F.count("*").alias("n")).collect()}
    assert got == {("dot3_0124.csv", 11): 3, ("dot3_0224.csv", 22): 3, ("dot3_0324.csv", 3): 1, ("dot3_0424.csv", 4): 3, ("dot3_0524.csv", 100): 1, ("dot3_0624.csv", 6): 3}
    taken = spark.createDataFrame([("2024-01",), ("2024-01",), ("2024-03",)], "period string")
    assert sorted(r["period"] for r in archives.first_copies(report, taken).collect()) == ["2024-02", "2024-04", "2024-05", "2024-06"]
    (year,) = archives.archive_years(report).collect()
    assert (year["year"], year["months"], year["further_copies"], year["damaged"], year["lines"]) == (2024, 6, 1, 1, 4 + 4 + 2 + 4 + 2 + 4)


class Sparse:
    """A file whose long runs of zeros are holes."""

    def __init__(self, path):
        self.f = open(path, "wb+")

    def write(self, data):
        if len(data) > 1 << 20 and not any(memoryview(data)[:64]):
            self.f.seek(len(data), 1)
            return len(data)
        return self.f.write(data)

    def __getattr__(self, name):
        return getattr(self.f, name)


def test_archive_above_two_gigabytes(spark, workdir):
    os.makedirs(f"{workdir}/z")
    sparse, block = Sparse(f"{workdir}/z/huge.zip"), bytes(1 << 24)
    with zipfile.ZipFile(sparse, "w", zipfile.ZIP_STORED) as z:
        z.writestr("dot3_0124.csv", _month(1))
        with z.open("padding.bin", "w", force_zip64=True) as f:
            for _ in range(136):
                f.write(block)
        z.writestr("dot3_0224.csv", _month(2))
    sparse.close()
    path = f"{workdir}/z/huge.zip"
    assert os.path.getsize(path) > 2 ** 31 and os.stat(path).st_blocks * 512 < 1 << 22
    report = archives.member_report(archives.member_directory(spark, path))
    assert {(r["member"], r["status"], r["lines"]) for r in report.collect()} == {("dot3_0124.csv", "ok", 4), ("dot3_0224.csv", "ok", 4)}


def test_members_are_checked_to_their_end():
    data = _zip([("a.csv", "1,2\n" * 1000)])
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        i = z.infolist()[0]
    hop = {"offset": i.header_offset, "packed": i.compress_size, "size": i.file_size, "method": i.compress_type, "flags": 0, "crc": i.CRC}
    assert zlib.crc32(b"".join(archives.data_of(io.BytesIO(data), hop))) == i.CRC
    for wrong in ({"crc": 1}, {"size": 3}, {"offset": 5}, {"method": 99}, {"flags": 1}):
        with pytest.raises(archives.DAMAGE):
            list(archives.data_of(io.BytesIO(data), hop | wrong))
    with pytest.raises(archives.DAMAGE):
        list(archives.data_of(io.BytesIO(data[:50]), hop))
