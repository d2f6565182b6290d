"""Shared helpers: tables, scratch tables on the shared folder, Arrow passes over texts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from portflow.session import checkpoint_root, subdir

#: ASCII white space of the contracts (x20, x09-x0D); ``bytes.split()`` splits on exactly these.
WHITE = b" \t\n\x0b\x0c\r"
#: bytes that don't start a code point in UTF-8
CONTINUATION = bytes(range(0x80, 0xC0))
#: lower-cases A-Z and leaves every other byte
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

ROWS_PER_BATCH = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the session's shared checkpoint folder (a local one only where none is set)."""
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        checkpoint_root(spark, fallback=tempfile.mkdtemp(prefix="portflow-"))
    return subdir(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, so lost executors cost no rerun."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, rows: int = ROWS_PER_BATCH) -> None:
    """Arrow batches of at most ``rows`` rows, so that a batch of long texts fits in a Python worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def texts(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    """The column as UTF-8 bytes (null stays None)."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def portions(values: list[bytes | None], most: int = 4 << 20) -> Iterator[list[bytes | None]]:
    """Consecutive parts of about ``most`` bytes (a longer text is a part of its own)."""
    part, size = [], 0
    for x in values:
        if part and size + len(x or b"") > most:
            yield part
            part, size = [], 0
        part.append(x)
        size += len(x or b"")
    if part:
        yield part


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[dict] | dict | None], schema: T.StructType) -> DataFrame:
    """``mapInArrow`` for functions that turn a batch into columns (a dict, or an iterator of dicts)."""
    bounded_batches(df.sparkSession)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            out = fn(batch)
            for columns in [out] if isinstance(out, dict) else out or ():
                yield pa.RecordBatch.from_arrays([as_array(columns[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def as_array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, kind)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until the table has no column of that name (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_measures(docs: DataFrame, measures: T.StructType, fn: Callable[[list[bytes | None]], list[tuple]],
                  name: str, text_col: str = "text") -> DataFrame:
    """``docs`` with one more struct column ``name``: ``fn`` maps a batch's texts to one tuple each.

    The other columns travel untouched, whatever their names are.
    """
    schema = T.StructType([*docs.schema.fields, T.StructField(name, measures, False)])
    kind = to_arrow_schema(T.StructType([T.StructField("x", measures)])).field("x").type

    def per_batch(batch: pa.RecordBatch) -> dict:
        rows = fn(texts(batch, text_col))
        parts = list(zip(*rows)) if rows else [[] for _ in kind]
        struct = pa.StructArray.from_arrays([pa.array(p, f.type) for p, f in zip(parts, kind)], fields=list(kind))
        return {c: batch.column(c) for c in batch.schema.names} | {name: struct}

    return map_arrow(docs, per_batch, schema)


def crc32_sql(text: str) -> str:
    """DuckDB SQL for the unsigned CRC-32 of an ASCII string."""
    bit = "lambda z, i: CASE WHEN z & 1 = 1 THEN xor(z >> 1, 3988292384::BIGINT) ELSE z >> 1 END"
    byte = f"lambda c, b: list_reduce([xor(c, b), 0::BIGINT, 0, 0, 0, 0, 0, 0, 0], {bit})"
    signs = f"list_transform(string_split({text}, ''), lambda s: ascii(s)::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {signs}), {byte}), 4294967295::BIGINT)"
