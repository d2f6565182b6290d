"""Packing by multiway differencing (Karmarkar-Karp).

Documents become runs of token ids, each ended by ``end_id``.  Whole windows are cut off a document's front; the rest
is cut into short pieces, so that partitions can be balanced.  Pieces are dealt by a hash into groups of about
``group_windows`` windows; inside a group, the two partial partitions with the largest imbalances are merged again and
again, the fullest window of one with the emptiest of the other, until one partition is left whose windows are nearly
equal.  If its fullest window exceeds the capacity, the group is partitioned anew into one window more.
"""

from __future__ import annotations

import heapq
import math
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portflow.llm.common import map_arrow, texts, written
from portflow.llm.tokens import word_bpe

END_ID = 2
CAPACITY = 4096
PIECE = 512
GROUP_WINDOWS = 128


def cuts(n: int, capacity: int, piece: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole windows first, then pieces of at most ``piece`` ids."""
    whole = n // capacity * capacity
    return [(s, capacity) for s in range(0, whole, capacity)] + [(s, min(piece, n - s)) for s in range(whole, n, piece)]


def differencing(sizes: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Deal ``sizes`` into ``m`` near-equal windows; gives each item's window and each window's sum.

    A partial partition is a pair (sums falling, node of each sum).  A node is an item or the union of two nodes.
    """
    n, left, right = len(sizes), [], []
    heap = []
    for k in np.argsort(-sizes, kind="stable").tolist():
        sums, node = np.zeros(m, np.int64), np.full(m, -1, np.int64)
        sums[0], node[0] = sizes[k], k
        heap.append((-int(sizes[k]) if m > 1 else 0, len(heap), sums, node))
    heapq.heapify(heap)
    tick = n
    while len(heap) > 1:
        _, _, a, x = heapq.heappop(heap)
        _, _, b, y = heapq.heappop(heap)
        sums, y = a + b[::-1], y[::-1]
        node = np.where(x >= 0, x, y)
        both = np.nonzero((x >= 0) & (y >= 0))[0]
        if len(both):
            node[both] = np.arange(n + len(left), n + len(left) + len(both))
            left += x[both].tolist()
            right += y[both].tolist()
        order = np.argsort(-sums, kind="stable")
        sums, node = sums[order], node[order]
        heapq.heappush(heap, (int(sums[-1] - sums[0]), tick, sums, node))
        tick += 1
    _, _, sums, node = heap[0]
    window = np.zeros(n + len(left), np.int64)
    window[node[node >= 0]] = np.nonzero(node >= 0)[0]
    for k in range(len(left) - 1, -1, -1):
        window[left[k]] = window[right[k]] = window[n + k]
    return window[:n], sums


def balanced(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of at most ``capacity``: their count rises whenever the capacity is exceeded."""
    m = max(1, math.ceil(int(sizes.sum()) / capacity))
    while True:
        window, sums = differencing(sizes, m)
        if sums.max() <= capacity:
            return window, sums
        m += 1


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, piece: int = PIECE, end_id: int = END_ID,
                 vocabulary: str | None = None) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens: each id of each text lies in exactly one piece."""
    path = vocabulary or public_tokenizers.path("word_bpe_49k.json")
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind)] + [T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens")])
    end = int(end_id).to_bytes(4, "little")

    def per_batch(batch: pa.RecordBatch) -> dict:
        bpe, owner, rows = word_bpe(path), [], []
        for k, text in enumerate(texts(batch, "text")):
            ids = bpe.ids(text or b"") + end
            n = len(ids) // 4
            for start, length in cuts(n, capacity, piece):
                owner.append(k)
                rows.append((start, length, zlib.crc32(ids[4 * start:4 * (start + length)]), n))
        start, length, crc, n = zip(*rows)
        return {"doc_id": batch.column("doc_id").take(pa.array(owner, pa.int64())), "start": start, "length": length, "ids_crc32": crc, "doc_tokens": n}

    return map_arrow(docs.select("doc_id", "text"), per_batch, schema)


def pack(docs: DataFrame, capacity: int = CAPACITY, piece: int = PIECE, group_windows: int = GROUP_WINDOWS,
         end_id: int = END_ID, vocabulary: str | None = None) -> DataFrame:
    """Pieces of all documents with their places: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts are one piece holding ``end_id``.  Repeated rows and null or repeated doc_ids are packed like
    any others.  Long texts become many pieces.  An empty table gives no rows.  Other columns are ignored.
    """
    if piece > capacity:
        raise ValueError("a piece must fit in a window")
    spark = docs.sparkSession
    pieces = written(token_pieces(docs, capacity, piece, end_id, vocabulary).withColumn("_row", F.monotonically_increasing_id()), "pieces")
    whole = pieces.where(F.col("length") == capacity).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("_row") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    short = pieces.where(F.col("length") < capacity)
    total = short.agg(F.sum("length")).first()[0] or 0
    groups = max(1, math.ceil(total / (group_windows * capacity)))
    dealt = short.withColumn("_group", F.pmod(F.xxhash64("_row", "ids_crc32"), F.lit(groups)))

    def place(part: pa.Table) -> pa.Table:
        part = part.sort_by([("length", "descending"), ("_row", "ascending")])
        sizes = part.column("length").to_numpy()
        window, _ = balanced(sizes, capacity)
        order = np.argsort(window, kind="stable")
        ends = np.cumsum(sizes[order])
        first = np.r_[True, window[order][1:] != window[order][:-1]]
        before = (ends - sizes[order])
        offset = np.empty(len(sizes), np.int64)
        offset[order] = before - np.maximum.accumulate(np.where(first, before, 0))
        group = part.column("_group")[0].as_py()
        return part.select(["doc_id", "start", "length", "ids_crc32", "doc_tokens"]).append_column(
            "sequence_id", pa.array((group * (1 << 20) + window) * 2, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    return whole.unionByName(dealt.groupBy("_group").applyInArrow(place, whole.schema))
