"""SimHash near-duplicates by tiled exact comparison.

Distinct fingerprints are dealt into tiles by the population counts of their four 16-bit quarters; a tile with many
fingerprints is split.  Two fingerprints within the radius have quarter counts that differ by no more than the radius
in all, so only tile pairs with such counts meet; every other pair is skipped.  A tile pair is compared whole, block by
block, with numpy exclusive-or and bit counts, and gives a spanning forest of its links instead of all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portflow.llm.common import LOWER, free_name, map_arrow, texts, written
from portflow.llm.components import connected_components

SHINGLE = 3
RADIUS = 2
SEED = 42
#: fingerprints in a tile, and comparisons made at once
TILE = 4096
BLOCK = 1 << 20
QUARTERS = 4


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> bytes:
    """8 bytes, highest first.  A bit is 1 if it is set in over half of the shingles' hashes; no words: zero."""
    w = text.translate(LOWER).split() if text else []
    n = len(w)
    if not n:
        return bytes(8)
    joined, digest = b" ".join(w), xxhash.xxh64_digest
    if n <= shingle:
        return digest(joined, SEED)
    sizes = np.fromiter(map(len, w), np.int64, n)
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[:n - shingle + 1].tolist()
    hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:].tolist())])
    bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
    return np.packbits(2 * bits.sum(0, dtype=np.int64) > len(bits)).tobytes()


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, carried: str | None = None) -> DataFrame:
    """doc_id, the long column ``carried`` if one is named, fp (the fingerprint as a signed long) of whole texts."""
    own = [T.StructField(carried, T.LongType())] if carried else []
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *own, T.StructField("fp", T.LongType())])

    def per_batch(batch: pa.RecordBatch) -> dict:
        flat = b"".join([fingerprint(x, shingle) for x in texts(batch, "text")])
        return {f.name: batch.column(f.name) for f in schema[:-1]} | {"fp": pa.array(np.frombuffer(flat, ">i8").astype(np.int64))}

    return map_arrow(docs.select(*(f.name for f in schema[:-1]), "text"), per_batch, schema)


def _forest(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Edges that span the links between ``a`` and ``b`` (or inside ``a``); as places in a and b laid end to end."""
    shift = 0 if same else len(a)
    label = np.arange(len(a) + (0 if same else len(b)))
    us, vs = [], []
    rows = max(1, BLOCK // max(1, len(b)))
    for i in range(0, len(a), rows):
        x, y = np.nonzero(np.bitwise_count(a[i:i + rows, None] ^ b[None, :]) <= radius)
        u, v = x + i, y + shift
        while True:
            p, q = label[u], label[v]
            open_ = p != q
            if not open_.any():
                break
            u, v, p, q = u[open_], v[open_], p[open_], q[open_]
            high, first = np.unique(np.maximum(p, q), return_index=True)
            us.append(u[first])
            vs.append(v[first])
            step = np.arange(len(label))
            step[high] = np.minimum(p, q)[first]
            while not np.array_equal(step, nxt := step[step]):
                step = nxt
            label = step[label]
    none = np.empty(0, np.int64)
    return (np.concatenate(us), np.concatenate(vs)) if us else (none, none)


def tiles(fps: DataFrame, tile: int = TILE) -> DataFrame:
    """sig (four counts), sub, fps: tiles of about ``tile`` distinct fingerprints."""
    sig = F.array(*(F.bit_count(F.shiftrightunsigned("fp", 16 * k).bitwiseAND(F.lit(0xFFFF))).cast("int") for k in range(QUARTERS)))
    signed = fps.select("fp", sig.alias("sig"))
    parts = signed.groupBy("sig").agg(F.ceil(F.count("*") / tile).cast("long").alias("parts"))  # at most 17**4 rows
    return signed.join(F.broadcast(parts), "sig").groupBy("sig", F.pmod(F.xxhash64("fp"), "parts").alias("sub")).agg(F.collect_list("fp").alias("fps"))


def links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(a, b) of distinct fingerprints: edges that join all fingerprints linked within ``radius`` bits."""
    made = written(tiles(fps, tile), "tiles")
    near = [d for d in product(range(-radius, radius + 1), repeat=QUARTERS) if sum(map(abs, d)) <= radius and d >= (0,) * QUARTERS]
    steps = F.array(*(F.array(*map(F.lit, d)) for d in near))
    left = made.select(F.col("sig").alias("own"), F.col("sub").alias("own_sub"), F.col("fps").alias("a"), F.explode(steps).alias("step"))
    left = left.withColumn("sig", F.zip_with("own", "step", lambda x, y: x + y)).drop("step")
    pairs = left.join(made.select("sig", "sub", F.col("fps").alias("b")), "sig").where((F.col("own") != F.col("sig")) | (F.col("own_sub") <= F.col("sub")))
    pairs = pairs.select("a", "b", ((F.col("own") == F.col("sig")) & (F.col("own_sub") == F.col("sub"))).alias("same"))
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def compare(batch: pa.RecordBatch) -> Iterator[dict]:
        left, right = batch.column("a"), batch.column("b")
        for k, same in enumerate(batch.column("same").to_pylist()):
            a = left[k].values.to_numpy().view(np.uint64)
            b = right[k].values.to_numpy().view(np.uint64)
            u, v = _forest(a, b, radius, same)
            if len(u):
                both = (a if same else np.concatenate([a, b])).view(np.int64)
                yield {"a": pa.array(both[u]), "b": pa.array(both[v])}

    return map_arrow(pairs, compare, schema)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (least doc_id reachable).

    Null and empty texts have fingerprint zero and are linked like any other.  Texts shorter than a shingle are one
    shingle.  Repeated rows share a component.  A null doc_id is never a component_id unless the whole component has
    none.  Other columns are ignored; an empty table gives no rows.
    """
    of = written(fingerprints(docs, shingle), "fingerprints")
    least = written(of.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct_fingerprints")
    roots = connected_components(links(least.select("fp"), radius, tile))
    rooted = least.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    first = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    component = rooted.join(first, "root").select("fp", "component_id")
    return of.join(component, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """One row of each component of linked texts; rows without doc_id can't be named and all stay.

    The row with the least doc_id stays; of several such rows of one doc_id that with the least hash of its text, and of
    rows equal in doc_id and text that with the least hash of all its columns.  Unlike texts of one doc_id are in
    components of their own, and each of them can stay.
    """
    key = free_name(docs, "text_key")
    keyed = docs.withColumn(key, F.xxhash64("text"))
    of = written(fingerprints(keyed.where("doc_id is not null"), shingle, key), "fingerprints")
    fps = written(of.select("fp").distinct(), "distinct_fingerprints")
    roots = connected_components(links(fps, radius, tile))
    rows = of.groupBy("doc_id", key, "fp").agg(F.count("*").alias("n")).join(roots, F.col("fp") == F.col("node"), "left")
    kept = rows.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min(F.struct("doc_id", key, "n")).alias("r"))
    kept = written(kept.select("r.doc_id", F.col("r")[key].alias(key), F.col("r.n").alias("n")), "kept")
    out = keyed.join(kept.where("n = 1"), ["doc_id", key], "left_semi").select(docs.columns)
    if kept.where("n > 1").limit(1).count():
        whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
        twins = keyed.join(kept.where("n > 1"), ["doc_id", key], "left_semi").groupBy("doc_id", key)
        out = out.unionByName(twins.agg(F.min_by(whole, F.xxhash64(F.to_json(whole))).alias("row")).select("row.*"))
    return out.unionByName(docs.where("doc_id is null")).select(*(F.col(f"`{c}`") for c in docs.columns))
