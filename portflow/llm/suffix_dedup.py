"""Suffix-array dedup of repeated byte strings.

A string of ``length`` bytes that also starts in a document with a smaller doc_id is removed wherever it occurs.

Sorting every suffix of the corpus would move fifty times its size, so only *anchored* suffixes are sorted: in every
string of ``length`` bytes, the ``GRAM``-byte token with the least hash is its anchor, wherever the string occurs.  An
anchor that only one document holds can't belong to a repeated string; a first exchange of token hashes drops these.
Sampled splitters then range-partition the remaining anchored suffixes by their leading bytes.  A bucket sorts its
suffixes, and the reversed contexts to their left, by multikey quicksort; common prefixes of neighbours then say, for
each string around an anchor, which suffixes share it and which of their doc_ids is the least.  Equal leading bytes
always fall between the same two splitters, and a string's anchor is longer than them; strings that begin before a
bucket's suffix are compared through its left context, so no match is lost at a boundary.

Documents travel in blocks of compressed text; everything that depends on a block is worked out again from it, so the
table of blocks, once written, is all that a lost executor needs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from portflow.llm.blocks import HEAD, HEADS_PER_BLOCK, pack_blocks, passed, rows, unpacked
from portflow.llm.common import written

LENGTH = 50
GRAM = 25
BLOCK_BYTES = 2 << 20
MAX_HEADS = 100_000
#: token hashes in a bucket of the first exchange; bytes of text for a bucket of suffixes
HASHES = 2_000_000
SUFFIX_BYTES = 8 << 20
_C = [np.uint64(pow(0x9E3779B97F4A7C15, 2 * j + 1, 1 << 64)) for j in range(12)]


class Block:
    """A block's text and its anchors; all of it follows from the block alone."""

    def __init__(self, ids: list, sizes: list[int], body: bytes, length: int):
        self.ids, self.length, self.reach = ids, length, length - GRAM
        self.text = np.frombuffer(unpacked(body), np.uint8)
        self.sizes = np.array(sizes, np.int64)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        self.anchors()

    def anchors(self) -> None:
        n, r = len(self.text), self.reach
        self.at, self.of, self.key, self.masks = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint32)
        if n < self.length:
            return
        grams = n - GRAM + 1
        raw = self.text.tobytes() + bytes(16)
        word = np.empty(n + 8, np.uint64)
        for j in range(8):
            part = np.frombuffer(raw, "<u8", (len(raw) - j) // 8, j)
            word[j::8] = part[:len(word[j::8])]
        h = word[:grams] * _C[0]
        h ^= h >> np.uint64(31)
        h += word[8:8 + grams] * _C[1]
        h *= _C[2]
        h ^= h >> np.uint64(29)
        h += word[16:16 + grams] * _C[3]
        h ^= h >> np.uint64(32)
        h *= _C[4]
        h += word[GRAM - 8:GRAM - 8 + grams] * _C[5]
        h ^= h >> np.uint64(30)
        h *= _C[6]
        h ^= h >> np.uint64(33)
        rank = (h >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        least = _sliding(rank, r + 1, np.minimum)  # of the string that starts at each place
        inside = np.zeros(n, bool)
        for i, s, e in zip(self.ids, self.starts.tolist(), self.ends.tolist()):
            if i is not None and e - s >= self.length:
                inside[s:e - self.length + 1] = True
        least[~inside[:len(least)]] = 0
        padded = np.zeros(grams + r, np.uint32)
        padded[r:r + len(least)] = least
        most = _sliding(padded, r + 1, np.maximum)
        self.at = np.nonzero(most == rank)[0]
        own = rank[self.at]
        self.masks = np.zeros(len(self.at), np.uint32)
        for a in range(r + 1):  # bit a: the string that starts a bytes before the anchor is inside a document, and this is its anchor
            self.masks |= (padded[self.at - a + r] == own).astype(np.uint32) << np.uint32(a)
        self.of = np.searchsorted(self.ends, self.at, side="right")
        self.key = h[self.at] & np.uint64((1 << 48) - 1)

    def tokens(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct token hashes, and for each anchor its place among them."""
        return np.unique(self.key, return_inverse=True)

    def contexts(self, at: np.ndarray, of: np.ndarray) -> np.ndarray:
        """The bytes from ``reach`` before to ``length`` after each anchor; zero outside its document."""
        cols = np.arange(-self.reach, self.length)
        where = at[:, None] + cols[None, :]
        out = self.text[np.clip(where, 0, len(self.text) - 1)]
        out[(where < self.starts[of][:, None]) | (where >= self.ends[of][:, None])] = 0
        return out

    def records(self, kept: np.ndarray) -> dict[str, np.ndarray]:
        """Anchors that ``kept`` names (by place among the tokens), those with equal contexts merged."""
        distinct, place = self.tokens()
        pick = kept[place]
        at, of, masks = self.at[pick], self.of[pick], self.masks[pick]
        ctx = self.contexts(at, of)
        wide = np.zeros((len(at), (ctx.shape[1] + 7) // 8 * 8 + 8), np.uint8)
        wide[:, :ctx.shape[1]] = ctx
        wide[:, -4:] = masks[:, None].view(np.uint8).reshape(-1, 4)
        mixed = np.zeros(len(at), np.uint64)
        words = wide.view(np.uint64)
        for j in range(words.shape[1]):
            mixed = (mixed ^ (mixed >> np.uint64(29)) ^ words[:, j]) * _C[j % 12]
        _, first, group = np.unique(mixed, return_index=True, return_inverse=True)
        odd = np.nonzero((words[first[group]] != words).any(1))[0]  # equal hash, other bytes: a record of its own
        group[odd] = len(first) + np.arange(len(odd))
        first = np.r_[first, odd]
        ids = np.array([-1 if i is None else i for i in self.ids], np.int64)[of]
        least = np.full(len(first), np.iinfo(np.int64).max)
        np.minimum.at(least, group, ids)
        return {"at": at, "of": of, "ids": ids, "masks": masks, "group": group, "ctx": ctx[first], "mask": masks[first], "least": least}


def _sliding(x: np.ndarray, width: int, fold) -> np.ndarray:
    """fold over x[i:i+width] for every i."""
    out, have = x, 1
    while have * 2 <= width:
        out, have = fold(out[:-have], out[have:]), have * 2
    return fold(out[:len(x) - width + 1], out[width - have:]) if have < width else out


# --- first exchange: tokens that more than one document holds ---------------------------------------------------------

_HASHES = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("block", T.StringType()), T.StructField("keys", T.BinaryType()), T.StructField("many", T.BinaryType())])
_SHARED = T.StructType([T.StructField("block", T.StringType()), T.StructField("bucket", T.LongType()), T.StructField("shared", T.BinaryType())])


def _each(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[dict, Block]]:
    for row in rows(batches):
        yield row, Block(row["ids"], row["sizes"], row["body"], length)


def _hashes(bits: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for row, b in _each(batches, length):
            distinct, place = b.tokens()
            if not len(distinct):
                continue
            low, high = np.full(len(distinct), len(b.ids)), np.full(len(distinct), -1)
            np.minimum.at(low, place, b.of)
            np.maximum.at(high, place, b.of)
            bucket = (distinct >> np.uint64(48 - bits)).astype(np.int64)
            cut = np.r_[np.nonzero(np.r_[True, bucket[1:] != bucket[:-1]])[0], len(bucket)].tolist()
            keys, many = (distinct & np.uint64((1 << 32) - 1)).astype("<u4"), high > low
            yield {"bucket": bucket[cut[:-1]], "block": [row["block"]] * (len(cut) - 1), "keys": [keys[s:e].tobytes() for s, e in zip(cut, cut[1:])],
                   "many": [np.packbits(many[s:e]).tobytes() for s, e in zip(cut, cut[1:])]}
    return run


def _shared(part: pa.Table) -> pa.Table:
    """Keys that two blocks hold, or one block in two documents."""
    keys = [np.frombuffer(x, "<u4") for x in part.column("keys").to_pylist()]
    many = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=len(k)) for x, k in zip(part.column("many").to_pylist(), keys)])
    flat = np.concatenate(keys)
    order = np.argsort(flat, kind="stable")
    equal = flat[order[1:]] == flat[order[:-1]]
    out = many.astype(bool)
    out[order[1:][equal]] = True
    out[order[:-1][equal]] = True
    # a key that one block holds twice is shared for all the others too, because they make it held by two blocks
    cut = np.cumsum([0, *map(len, keys)]).tolist()
    return pa.table({"block": part.column("block"), "bucket": part.column("bucket"), "shared": pa.array([np.packbits(out[s:e]).tobytes() for s, e in zip(cut, cut[1:])])},
                    schema=to_arrow_schema(_SHARED))


def _kept(b: Block, replies: list[dict], bits: int) -> np.ndarray:
    distinct, _ = b.tokens()
    bucket = (distinct >> np.uint64(48 - bits)).astype(np.int64)
    out = np.zeros(len(distinct), bool)
    for r in replies or ():
        s, e = np.searchsorted(bucket, [r["bucket"], r["bucket"] + 1])
        out[s:e] = np.unpackbits(np.frombuffer(r["shared"], np.uint8), count=e - s)
    return out


# --- second exchange: suffixes, range-partitioned by their leading bytes ---------------------------------------------

_SUFFIXES = T.StructType([T.StructField("part", T.LongType()), T.StructField("block", T.StringType()), T.StructField("n", T.LongType()), T.StructField("body", T.BinaryType())])
_FOUND = T.StructType([T.StructField("block", T.StringType()), T.StructField("part", T.LongType()), T.StructField("found", T.BinaryType())])


def _parts(rec: dict[str, np.ndarray], splitters: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    heads = np.ascontiguousarray(rec["ctx"][:, reach:reach + HEAD]).view(f"S{HEAD}").ravel()
    part = np.searchsorted(splitters, heads, side="right")
    return part, np.argsort(part, kind="stable")


def _suffixes(bits: int, length: int, splitters: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        press = zstandard.ZstdCompressor(level=3)
        for row, b in _each(batches, length):
            kept = _kept(b, row["replies"], bits)
            if not kept.any():
                continue
            rec = b.records(kept)
            part, order = _parts(rec, splitters, b.reach)
            part = part[order]
            cut = np.r_[np.nonzero(np.r_[True, part[1:] != part[:-1]])[0], len(part)].tolist()
            own = [order[s:e] for s, e in zip(cut, cut[1:])]
            yield {"part": part[cut[:-1]], "block": [row["block"]] * len(own), "n": list(map(len, own)),
                   "body": [press.compress(rec["ctx"][r].tobytes() + rec["mask"][r].astype("<u4").tobytes() + rec["least"][r].astype("<i8").tobytes()) for r in own]}
    return run


def multikey_order(text: np.ndarray) -> np.ndarray:
    """Order of byte rows by multikey quicksort: only rows that are equal so far are sorted by their next 8 bytes."""
    n, width = text.shape
    wide = np.zeros((n, (width + 7) // 8 * 8), np.uint8)
    wide[:, :width] = text
    words = wide.view(">u8").astype(np.uint64)
    order = np.argsort(words[:, 0], kind="stable")
    tied = np.r_[False, words[order[1:], 0] == words[order[:-1], 0]]
    for j in range(1, words.shape[1]):
        open_ = tied | np.r_[tied[1:], False]
        if not open_.any():
            break
        at = np.nonzero(open_)[0]
        group = np.cumsum(~tied)[at]
        sub = order[at]
        order[at] = sub[np.lexsort((words[sub, j], group))]
        same = np.zeros(n, bool)
        same[1:] = words[order[1:], j] == words[order[:-1], j]
        tied &= same
    return order


def _common(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row with its neighbour before, in sorted order."""
    out = np.zeros(len(text), np.int64)
    a, b = text[order[1:]], text[order[:-1]]
    alive = np.ones(len(a), bool)
    for j in range(text.shape[1]):
        alive &= a[:, j] == b[:, j]
        out[1:] += alive
    return out


def earlier(ctx: np.ndarray, mask: np.ndarray, doc: np.ndarray, length: int) -> np.ndarray:
    """For each suffix a bit per string around its anchor: does it also start in a smaller doc_id's document?"""
    n, reach = len(ctx), length - GRAM
    right, left = ctx[:, reach:], ctx[:, reach - 1::-1]
    r_order, l_order = multikey_order(right), multikey_order(left)
    r_same, l_same = _common(right, r_order), _common(left, l_order)
    by_doc = np.argsort(doc, kind="stable")
    out, r_class, l_class = np.zeros(n, np.uint32), np.empty(n, np.int64), np.empty(n, np.int64)
    for a in range(reach + 1):
        own = by_doc[(mask[by_doc] >> np.uint32(a)) & np.uint32(1) > 0]
        if len(own) < 2:
            continue
        r_class[r_order] = np.cumsum(r_same < length - a)
        l_class[l_order] = np.cumsum(l_same < a)
        pair = r_class[own] * (n + 1) + l_class[own]
        order = np.argsort(pair, kind="stable")
        run = np.cumsum(np.r_[True, pair[order[1:]] != pair[order[:-1]]]) - 1
        least = doc[own[order]][np.r_[True, run[1:] != run[:-1]]]  # they come by rising doc_id
        hit = own[order][doc[own[order]] > least[run]]
        out[hit] |= np.uint32(1 << a)
    return out


def _found(length: int):
    width = 2 * length - GRAM

    def run(part: pa.Table) -> pa.Table:
        open_, ctx, mask, doc = zstandard.ZstdDecompressor(), [], [], []
        sizes = part.column("n").to_pylist()
        for n, body in zip(sizes, part.column("body").to_pylist()):
            raw = open_.decompress(body)
            ctx.append(np.frombuffer(raw, np.uint8, n * width).reshape(n, width))
            mask.append(np.frombuffer(raw, "<u4", n, n * width))
            doc.append(np.frombuffer(raw, "<i8", n, n * width + 4 * n))
        found = earlier(np.concatenate(ctx), np.concatenate(mask), np.concatenate(doc), length).astype("<u4")
        cut = np.cumsum([0, *sizes]).tolist()
        return pa.table({"block": part.column("block"), "part": part.column("part"), "found": pa.array([found[s:e].tobytes() for s, e in zip(cut, cut[1:])])},
                        schema=to_arrow_schema(_FOUND))
    return run


# --- cutting ---------------------------------------------------------------------------------------------------------

_RESULT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()),
                        T.StructField("removed", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
                        T.StructField("kept", T.BinaryType())])


def _cut(bits: int, length: int, splitters: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for row, b in _each(batches, length):
            covered = np.zeros(len(b.text), bool)
            if row["found"]:
                rec = b.records(_kept(b, row["replies"], bits))
                part, order = _parts(rec, splitters, b.reach)
                part = part[order]
                bit = np.zeros(len(part), np.uint32)
                for f in row["found"]:
                    s, e = np.searchsorted(part, [f["part"], f["part"] + 1])
                    bit[order[s:e]] = np.frombuffer(f["found"], "<u4")
                # a document after the least one of its block's copies has that one before it
                own = np.where(rec["ids"] > rec["least"][rec["group"]], rec["masks"], bit[rec["group"]])
                starts = np.zeros(len(b.text), bool)
                for a in range(b.reach + 1):
                    starts[rec["at"][(own >> np.uint32(a)) & np.uint32(1) > 0] - a] = True
                total = np.cumsum(starts)
                covered = total > np.r_[np.zeros(min(length, len(total)), total.dtype), total[:-length]]
            step = np.diff(np.r_[np.int8(0), covered.astype(np.int8), np.int8(0)])
            first, last = np.nonzero(step == 1)[0], np.nonzero(step == -1)[0]
            out: dict[str, list] = {"doc_id": b.ids, "n_bytes": b.sizes, "removed": [], "kept": []}
            for s, e in zip(b.starts.tolist(), b.ends.tolist()):
                # a run may go on into the next document: it ends with its own
                i, j = np.searchsorted(last, s, side="right"), np.searchsorted(first, e)
                out["removed"].append([{"start": max(x, s) - s, "end": min(y, e) - s} for x, y in zip(first[i:j].tolist(), last[i:j].tolist())])
                out["kept"].append(b.text[s:e][~covered[s:e]].tobytes())
            yield out
    return run


def dedup_substrings(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per document: doc_id, n_bytes, removed (maximal runs, start and end in bytes), kept (the other bytes).

    Texts count as UTF-8 bytes, so a cut may part a code point.  Null and empty texts have no bytes; texts shorter
    than ``length`` keep all.  A null doc_id is neither smaller nor larger than another: such rows keep all and make
    nothing go.  Rows that share a doc_id don't make each other go.  Other columns are ignored; an empty table gives
    no rows.
    """
    if not GRAM < length <= GRAM + 31:
        raise ValueError(f"length must be above {GRAM} and at most {GRAM + 31}")
    spark = docs.sparkSession
    blocks = pack_blocks(docs, BLOCK_BYTES)
    n_blocks, total = blocks.agg(F.count("*"), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    bits = max(4, min(16, (total // 13 // HASHES).bit_length()))
    share = min(1.0, MAX_HEADS / HEADS_PER_BLOCK / max(1, n_blocks))
    heads = np.sort(np.array([bytes(r[0]) for r in blocks.sample(share, 7).select(F.explode("heads")).collect()], f"S{HEAD}"))
    wanted = max(8, total // SUFFIX_BYTES)
    splitters = np.unique(heads[np.linspace(0, len(heads) - 1, min(wanted, len(heads)) + 1).astype(int)[1:-1]]) if len(heads) > 2 else heads[:0]

    text = blocks.select("block", "ids", "sizes", "body")
    hashes = passed(text, _hashes(bits, length), _HASHES)
    replies = hashes.groupBy("bucket").applyInArrow(_shared, _SHARED).groupBy("block").agg(F.collect_list(F.struct("bucket", "shared")).alias("replies"))
    replies = written(replies, "shared_tokens")
    asked = text.join(replies, "block")
    found = passed(asked, _suffixes(bits, length, splitters), _SUFFIXES).groupBy("part").applyInArrow(_found(length), _FOUND)
    found = written(found.groupBy("block").agg(F.collect_list(F.struct("part", "found")).alias("found")), "repeated_suffixes")
    answered = text.join(replies, "block", "left").join(found, "block", "left")
    return passed(answered, _cut(bits, length, splitters), _RESULT)


def digest(result: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return result.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
