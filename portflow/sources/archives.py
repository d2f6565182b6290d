"""Archives as Spark jobs, member by member.

1. ``member_directory``: tasks read each archive's central directory by byte
   range (its tail, not its contents), so an archive may be of any size.
   Archives inside archives give their members in a next round.
2. ``member_report``: one row per member in scope, read to its end once by a
   task of its own: status, check sum, size, lines and header line.
3. ``member_lines`` / ``read_archived_csv``: the lines of the members that are
   wanted.  For a feed, the first sound copy of each month is wanted.

Damaged members (truncated, bad CRC, corrupt data, encrypted, unknown
compression method) give a row with that status instead of failing the job.
Members that are out of scope are never opened.
"""

from __future__ import annotations

import bz2
import codecs
import io
import re
import struct
import zipfile
import zlib
from typing import BinaryIO, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from portflow.operators.joins import bounded_broadcast
from portflow.session import staged
from portflow.sources import ranged
from portflow.sources.files import by_header, distinct_layouts, national_file_period, text_columns

#: what a damaged, encrypted or unknown member raises
DAMAGE = (zipfile.BadZipFile, zlib.error, struct.error, EOFError, OSError, ValueError, RuntimeError, NotImplementedError)
STEP = 1 << 20
LINES_PER_BATCH = 20_000
#: most tasks of one pass over members
MAX_TASKS = 4096


def _struct(**kinds) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in kinds.items()])


S, I, L = T.StringType(), T.IntegerType(), T.LongType()
#: where a member lies: one hop into the archive, further ones into archives inside it
HOP = _struct(offset=L, packed=L, size=L, method=I, flags=I, crc=L)
MEMBERS = _struct(path=S, archive=S, member=S, kind=S, hops=T.ArrayType(HOP))
REPORT = T.StructType([*MEMBERS.fields, *_struct(status=S, lines=L, size=L, header=S).fields])
LINES = _struct(archive=S, member=S, line_no=L, line=S)


def data_of(file: BinaryIO, hop: Mapping) -> Iterator[bytes]:
    """A member's contents piece by piece; damage shows at the latest at its end."""
    if hop["flags"] & 1:
        raise RuntimeError("encrypted member")
    file.seek(hop["offset"])
    head = file.read(30)
    if head[:4] != b"PK\x03\x04":
        raise zipfile.BadZipFile("no member at its place")
    name, extra = struct.unpack("<HH", head[26:30])
    file.seek(hop["offset"] + 30 + name + extra)
    makers = {zipfile.ZIP_STORED: lambda: None, zipfile.ZIP_DEFLATED: lambda: zlib.decompressobj(-15), zipfile.ZIP_BZIP2: bz2.BZ2Decompressor}
    if hop["method"] not in makers:
        raise NotImplementedError(f"compression method {hop['method']}")
    unpack = makers[hop["method"]]()
    left, crc, size = hop["packed"], 0, 0

    def checked(piece: bytes) -> bytes:
        nonlocal crc, size
        crc, size = zlib.crc32(piece, crc), size + len(piece)
        return piece

    while left:
        packed = file.read(min(STEP, left))
        if not packed:
            raise EOFError("truncated member")
        left -= len(packed)
        if unpack is None:
            yield checked(packed)
        elif isinstance(unpack, bz2.BZ2Decompressor):
            yield checked(unpack.decompress(packed))
        else:
            while packed:
                yield checked(unpack.decompress(packed, STEP))
                packed = unpack.unconsumed_tail
    if size != hop["size"] or crc != hop["crc"]:
        raise zipfile.BadZipFile("size or check sum differs")


def opened(path: str, hops: list[Mapping]) -> BinaryIO:
    """The archive that holds the last hop: the file itself, a range of it, or an unpacked inner archive."""
    file = ranged.open_ranged(path)
    for hop in hops[:-1]:
        if hop["method"] == zipfile.ZIP_STORED and not hop["flags"] & 1:
            file.seek(hop["offset"] + 26)
            name, extra = struct.unpack("<HH", file.read(4))
            file = io.BufferedReader(ranged.Range(file, hop["offset"] + 30 + name + extra, hop["packed"]))
        else:
            file = io.BytesIO(b"".join(data_of(file, hop)))
    return file


def lines_of(pieces: Iterator[bytes]) -> Iterator[list[str]]:
    """Lines without their ends, as many at a time as one piece completes."""
    decode, held = codecs.getincrementaldecoder("utf-8")("replace"), ""
    for piece in pieces:
        *whole, held = (held + decode.decode(piece)).split("\n")
        if whole:
            yield [x.removesuffix("\r") for x in whole]
    held += decode.decode(b"", True)
    if held:
        yield [held.removesuffix("\r")]


def _pass(rows: DataFrame, fn, schema: T.StructType) -> DataFrame:
    """``fn`` (one row -> lists of rows) over rows that are dealt out one by one."""
    arrow = to_arrow_schema(schema)
    rows = rows.repartition(max(1, min(MAX_TASKS, rows.count())))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                for out in fn(row):
                    yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return rows.mapInArrow(run, schema)


def member_directory(spark: SparkSession, path: str, member_regex: str = r"\.csv$", max_depth: int = 3) -> DataFrame:
    """path, archive, member, kind, hops of the members in scope of the archives under ``path`` (glob allowed).

    kind is 'member', or 'bad_archive' / 'damaged' for archives (inner ones) whose directory can't be read.
    """
    keep = re.compile(member_regex, re.IGNORECASE)

    def entries(row: dict) -> Iterator[list[dict]]:
        prefix = f"{row['member']}!/" if row["member"] else ""
        same = {"path": row["path"], "archive": row["archive"]}
        try:
            file = opened(row["path"], [*row["hops"], None])
            infos = zipfile.ZipFile(file).infolist()
        except DAMAGE:
            yield [same | {"member": row["member"] or row["archive"], "kind": "damaged" if row["member"] else "bad_archive", "hops": row["hops"]}]
            return
        out = []
        for i in infos:
            inner = i.filename.lower().endswith(".zip") and len(row["hops"]) < max_depth
            if not i.is_dir() and (inner or keep.search(i.filename.rsplit("/", 1)[-1])):
                hop = {"offset": i.header_offset, "packed": i.compress_size, "size": i.file_size, "method": i.compress_type, "flags": i.flag_bits, "crc": i.CRC}
                out.append(same | {"member": prefix + i.filename, "kind": "archive" if inner else "member", "hops": [*row["hops"], hop]})
        yield out

    found = ranged.list_files(spark, [path])
    none = F.array().cast(T.ArrayType(HOP))
    todo = found.select("path", F.col("file").alias("archive"), F.lit(None).cast("string").alias("member"), F.lit("archive").alias("kind"), none.alias("hops"))
    out = None
    for _ in range(max_depth + 1):
        level = staged(_pass(todo, entries, MEMBERS), "directory")
        done, todo = level.where("kind <> 'archive'"), level.where("kind = 'archive'")
        out = done if out is None else out.unionByName(done)
        if not todo.limit(1).count():
            break
    return out


def member_report(directory: DataFrame) -> DataFrame:
    """The directory with status ('ok', 'damaged', 'bad_archive'), lines, size, header and period; one task a member."""
    def read(row: dict) -> Iterator[list[dict]]:
        if row["kind"] != "member":
            yield [row | {"status": row["kind"], "lines": 0, "size": None, "header": None}]
            return
        n, header = 0, None
        try:
            for part in lines_of(data_of(opened(row["path"], row["hops"]), row["hops"][-1])):
                if header is None:
                    header = next((x for x in part if x.strip("\ufeff \t")), None)
                n += len(part)
        except DAMAGE:
            yield [row | {"status": "damaged", "lines": 0, "size": None, "header": None}]
            return
        yield [row | {"status": "ok", "lines": n, "size": row["hops"][-1]["size"], "header": header}]

    return staged(_pass(directory, read, REPORT), "members").withColumn("period", national_file_period(F.col("member")))


def first_copies(report: DataFrame, taken: DataFrame | None = None) -> DataFrame:
    """One sound member per period: the first by archive and member name; none for periods in ``taken`` (period)."""
    sound = report.where("status = 'ok' AND period IS NOT NULL")
    if taken is not None:
        sound = sound.join(bounded_broadcast(taken.select("period").distinct()), "period", "left_anti")
    row = F.struct(*report.columns)
    return sound.groupBy("period").agg(F.min_by(row, F.struct("archive", "member")).alias("r")).select("r.*")


def member_lines(members: DataFrame) -> DataFrame:
    """archive, member, line_no, line of sound members; a member is one task, its lines are many rows."""
    def read(row: dict) -> Iterator[list[dict]]:
        n = 0
        for part in lines_of(data_of(opened(row["path"], row["hops"]), row["hops"][-1])):
            for k in range(0, len(part), LINES_PER_BATCH):
                yield [{"archive": row["archive"], "member": row["member"], "line_no": n + i, "line": x} for i, x in enumerate(part[k:k + LINES_PER_BATCH], k)]
            n += len(part)

    return _pass(members.select(*MEMBERS.fieldNames()), read, LINES)


def expand_archives(spark: SparkSession, path: str, member_regex: str = r"\.csv$", max_depth: int = 3) -> DataFrame:
    """Rows (archive, member, status, line_no, line, size, period) of all members in scope; a member without lines gives one row."""
    report = member_report(member_directory(spark, path, member_regex, max_depth))
    told = report.select("archive", "member", "status", "size", "period")
    full = report.where("status = 'ok' AND lines > 0")
    rows = member_lines(full).join(bounded_broadcast(told), ["archive", "member"])
    bare = told.join(full.select("archive", "member"), ["archive", "member"], "left_anti")
    return rows.unionByName(bare, allowMissingColumns=True).select("archive", "member", "status", "line_no", "line", "size", "period")


def read_archived_csv(members: DataFrame, schema: T.StructType, file_col: str = "_file") -> DataFrame:
    """CSV rows of report members (see ``first_copies``) by column name; ``file_col`` is archive!/member."""
    name = F.concat("archive", F.lit("!/"), "member")
    heads = members.where("header IS NOT NULL").select(name.alias("file"), "header")
    layouts = distinct_layouts(heads)
    if not layouts:
        return members.sparkSession.createDataFrame([], T.StructType([*schema.fields, T.StructField(file_col, S)]))
    header = heads.select(F.col("file").alias(file_col), "header")
    lines = member_lines(members.where("header IS NOT NULL")).select(name.alias(file_col), "line_no", "line")
    # a header line is told by its text: it can follow empty lines, and never is a row of data
    data = lines.join(bounded_broadcast(header), file_col).where((F.trim("line") != "") & (F.col("line") != F.col("header")))
    rows = data.select(F.from_csv("line", ", ".join(f"{c} string" for c in text_columns(layouts).fieldNames())).alias("c"), file_col).select("c.*", file_col)
    return by_header(rows, heads, layouts, schema, file_col)


def archive_report(report: DataFrame) -> DataFrame:
    """Per archive: members ok / damaged, lines, bytes of the ok members."""
    ok = F.col("status") == "ok"
    return report.groupBy("archive").agg(
        F.count_if(ok).alias("members_ok"), F.count_if(~ok).alias("members_damaged"),
        F.sum(F.when(ok, F.col("lines")).otherwise(0)).alias("lines"), F.sum(F.when(ok, F.col("size")).otherwise(0)).alias("bytes_ok"))


def archive_years(report: DataFrame) -> DataFrame:
    """Per year of the members' periods: months with a sound copy, further copies, damaged copies, lines and bytes of the copies used."""
    used = first_copies(report).select("archive", "member", F.lit(True).alias("used"))
    x = report.where("period IS NOT NULL").join(bounded_broadcast(used), ["archive", "member"], "left")
    ok, used = F.col("status") == "ok", F.coalesce("used", F.lit(False))
    return x.groupBy(F.substring("period", 1, 4).cast("int").alias("year")).agg(
        F.count_if(used).alias("months"), F.count_if(ok & ~used).alias("further_copies"), F.count_if(~ok).alias("damaged"),
        F.sum(F.when(used, F.col("lines")).otherwise(0)).alias("lines"), F.sum(F.when(used, F.col("size")).otherwise(0)).alias("bytes"))
