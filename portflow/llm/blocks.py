"""Documents in blocks of compressed text, written once: whatever follows from a block can be worked out again."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from portflow.llm.common import as_array, bounded_batches, written

#: rows of the table of blocks in an Arrow batch
BLOCK_ROWS = 16
HEAD = 16
HEADS_PER_BLOCK = 32

SCHEMA = T.StructType([T.StructField("block", T.StringType()), T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("sizes", T.ArrayType(T.LongType())),
                       T.StructField("labels", T.ArrayType(T.StringType())),
                       T.StructField("heads", T.ArrayType(T.BinaryType())), T.StructField("n_bytes", T.LongType()), T.StructField("body", T.BinaryType())])


def passed(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: T.StructType) -> DataFrame:
    """``mapInArrow`` where ``fn`` turns the iterator of batches into an iterator of columns."""
    bounded_batches(df.sparkSession, BLOCK_ROWS)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in fn(batches):
            yield pa.RecordBatch.from_arrays([as_array(columns[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield {c: batch.column(c)[k].as_py() for c in batch.schema.names}


def pack_blocks(docs: DataFrame, block_bytes: int, label: str | None = None) -> DataFrame:
    """block, ids, sizes, labels (of the column so named), heads (a few samples of the text), n_bytes, body: about ``block_bytes`` of text a row.

    doc_id becomes a long; a null text is an empty one; a longer text is a block of its own.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        press = zstandard.ZstdCompressor(level=3)

        def block(ids: list, labels: list, parts: list[bytes]) -> dict:
            body = b"".join(parts)
            step = max(1, len(body) // HEADS_PER_BLOCK)
            return {"block": [uuid.uuid4().hex], "ids": [ids], "sizes": [list(map(len, parts))], "labels": [labels], "n_bytes": [len(body)],
                    "heads": [[body[i:i + HEAD] for i in range(0, len(body), step)]], "body": [press.compress(body)]}

        ids, labels, parts, size = [], [], [], 0
        for batch in batches:
            for i, name, text in zip(batch.column("doc_id").to_pylist(), batch.column("label").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                if parts and size + len(text or b"") > block_bytes:
                    yield block(ids, labels, parts)
                    ids, labels, parts, size = [], [], [], 0
                ids.append(i)
                labels.append(name)
                parts.append(text or b"")
                size += len(parts[-1])
        if parts:
            yield block(ids, labels, parts)

    named = F.col(f"`{label}`").cast("string") if label else F.lit(None).cast("string")
    return written(passed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), named.alias("label"), "text"), run, SCHEMA), "blocks")


def unpacked(body: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(body)
