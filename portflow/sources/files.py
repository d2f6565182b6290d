"""Readers of the raw feeds: CSV (by name, never inferred), JSON pages,
code-lookup objects, and file-name period parsing.

All readers declare their schema; the file each row came from is kept in
``_file`` (``input_file_name``), which is how periods and provenance are
derived without listing files on the driver.
"""

from __future__ import annotations

import csv
from functools import reduce
from typing import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portflow.operators.joins import bounded_broadcast
from portflow.session import staged
from portflow.sources import ranged


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
             file_col: str | None = "_file") -> DataFrame:
    """One CSV family with a header, declared schema, malformed values -> NULL."""
    df = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
          .csv(path if isinstance(path, str) else list(path)))
    return df.withColumn(file_col, F.input_file_name()) if file_col else df


#: files whose headers one job asks for where only Spark's readers reach the store
HEADS_PER_JOB = 64


def csv_headers(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, header): the first line with content of every file, whatever the files' sizes.

    Tasks open the listed files and read their first kilobytes.  Where only
    Spark's readers reach the store, jobs of a few files each stop at the first
    line of every one.  Empty files give no row.  Eager; the rows are written
    to the shared folder.
    """
    found = ranged.list_files(spark, _paths(path))
    schema = T.StructType([T.StructField("file", T.StringType()), T.StructField("header", T.StringType())])
    if found.where(~F.regexp_extract("path", "^([a-z0-9]*):", 1).isin(*ranged.SCHEMES)).limit(1).count():
        names = [(r["path"], r["file"]) for r in found.select("path", "file").collect()]
        out = spark.createDataFrame([], schema)
        for k in range(0, len(names), HEADS_PER_JOB):
            lines = [spark.read.text(x).where(F.trim("value", F.lit("\ufeff \t\r")) != "").limit(1).select(F.lit(file).alias("file"), F.col("value").alias("header"))
                     for x, file in names[k:k + HEADS_PER_JOB]]
            out = out.unionByName(staged(reduce(DataFrame.unionByName, lines), "headers"))
        return out

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path, file in zip(batch.column("path").to_pylist(), batch.column("file").to_pylist()):
                with ranged.open_ranged(path) as f:
                    rows.append({"file": file, "header": ranged.first_line(f).decode("utf-8", "replace")})
            yield pa.RecordBatch.from_pylist([r for r in rows if r["header"]], schema=pa.schema([("file", pa.string()), ("header", pa.string())]))

    spread = found.repartition(max(1, min(spark.sparkContext.defaultParallelism * 4, found.count() // 8 + 1)))
    return staged(spread.mapInArrow(heads, schema), "headers")


def _paths(path: str | Iterable[str | Sequence[str]]) -> list[str]:
    return [path] if isinstance(path, str) else [x for p in path for x in _paths(p)]


def header_names(header: str) -> list[str]:
    """Column names of a header line: quotes and a byte-order mark removed, lower case."""
    return [c.strip().lower() for c in next(csv.reader([header.lstrip("\ufeff").strip("\r")]), [])]


#: header layouts of one feed; more than that are no eras of a feed but a wrong path
MAX_LAYOUTS = 1000


def by_header(rows: DataFrame, heads: DataFrame, layouts: Sequence[str], schema: T.StructType, key: str) -> DataFrame:
    """Positional text columns ``_c0 ...`` of ``rows`` -> the declared columns by name.

    ``heads`` (file, header) says which layout a file has; ``layouts`` are the
    distinct headers.  A declared column that a layout lacks, and a value that
    does not parse, become NULL; names compare without case, the first of
    equal names counts.
    """
    files = heads.select(F.col("file").alias(key), F.array_position(F.array(*map(F.lit, layouts)), F.col("header")).alias("_layout"))
    named = rows.join(bounded_broadcast(files), key)
    positions = [header_names(h) for h in layouts]

    def column(f: T.StructField) -> Column:
        places: dict[int, list[int]] = {}
        for k, names in enumerate(positions, 1):
            if f.name.lower() in names:
                places.setdefault(names.index(f.name.lower()), []).append(k)
        out = F.lit(None).cast("string")
        for at, which in places.items():
            out = F.when(F.col("_layout").isin(which), F.col(f"_c{at}")).otherwise(out)
        return (out if f.dataType == T.StringType() else F.trim(out).try_cast(f.dataType)).alias(f.name)

    return named.select(*[column(f) for f in schema.fields], key)


def text_columns(layouts: Sequence[str]) -> T.StructType:
    """``_c0 ...``: as many text columns as the widest layout has."""
    return T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(max(len(header_names(h)) for h in layouts))])


def distinct_layouts(heads: DataFrame) -> list[str]:
    found = sorted(r["header"] for r in heads.select("header").distinct().limit(MAX_LAYOUTS + 1).collect())
    if len(found) > MAX_LAYOUTS:
        raise ValueError(f"more than {MAX_LAYOUTS} header layouts")
    return found


def read_csv_by_name(spark: SparkSession, path: str | Iterable[str | Sequence[str]], schema: T.StructType,
                     file_col: str | None = "_file") -> DataFrame:
    """CSV files of any header layouts *by column name*, in one scan.

    Headers are found with one small read per file; the rows of all files are
    then read once as text columns by position, and each file's layout says
    which position a declared column has.
    """
    heads = csv_headers(spark, path)
    layouts = distinct_layouts(heads)
    if not layouts:
        raise ValueError("no CSV file with a header given")
    key = file_col or "_file"
    raw = (spark.read.schema(text_columns(layouts)).option("header", True).option("mode", "PERMISSIVE").csv(_paths(path))
           .select("*", F.col("_metadata.file_path").alias(key)))
    out = by_header(raw, heads, layouts, schema, key)
    return out if file_col else out.drop(key)


def read_json_pages(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
                    file_col: str | None = "_file") -> DataFrame:
    """Saved API pages: each file is one JSON array of objects."""
    df = spark.read.schema(schema).option("multiLine", True).json(path if isinstance(path, str) else list(path))
    return df.withColumn(file_col, F.input_file_name()) if file_col else df


def read_code_lookup(spark: SparkSession, path: str, meta_key: str = "_meta") -> DataFrame:
    """A ``{code: label, ..., "_meta": {...}}`` object -> rows (code, label)."""
    txt = spark.read.text(path, wholetext=True)
    m = F.from_json(F.col("value"), "map<string,string>")
    return txt.select(F.explode(F.map_filter(m, lambda k, v: k != F.lit(meta_key))).alias("code", "label"))


# --- file-name period --------------------------------------------------------

def file_name(path_col: str | Column = "_file") -> Column:
    c = F.col(path_col) if isinstance(path_col, str) else path_col
    return F.element_at(F.split(c, "/"), -1)


def national_file_period(path_col: str | Column = "_file", pivot: int = 30, min_year: int = 2006) -> Column:
    """``dot3_MMYY.csv`` (any case) -> 'yyyy-MM'; NULL when out of scope.

    Two-digit years up to ``pivot`` are 20YY, later ones 19YY; the month must
    be 1..12 (so a yearly ``dot3_2009.csv`` is rejected), year-to-date files
    (``_ytd_``) are excluded, and years before ``min_year`` are dropped.
    """
    name = file_name(path_col)
    mm = F.regexp_extract(name, r"(?i)^dot3_([0-9]{2})([0-9]{2})\.csv$", 1)
    yy = F.regexp_extract(name, r"(?i)^dot3_([0-9]{2})([0-9]{2})\.csv$", 2)
    yi = yy.try_cast("int")
    year = F.when(yi <= pivot, yi + 2000).otherwise(yi + 1900)
    mi = mm.try_cast("int")
    ok = (mm != "") & ~name.rlike("(?i)_ytd_") & mi.between(1, 12) & (year >= min_year)
    return F.when(ok, F.format_string("%04d-%02d", year, mi))
