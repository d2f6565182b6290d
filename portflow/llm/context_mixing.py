"""Language-model scoring by online logistic context mixing over the running text.

A text is a run of tokens: its words, lower-cased, and one end.  Every token is a run of binary decisions, each predicted
from several hashed contexts that reach across words:

* whether it is the word that most often follows the two words before it in all other training texts;
* whether it is the word that followed them last time in this text;
* else its Huffman code over the training corpus's frequent words (``VOCABULARY``), bit by bit, where an escape leads to
* whether the rare word has stood in this text already, and if not its spelling, byte by byte.

Contexts of a decision are the last one and two of the most frequent words and the word before, and for the first two
decisions how sure the corpus is and how the last decisions came out.  A context's counts of zeros and
ones over all training text lie in a hashed table whose size follows the training bytes up to a bound.  The predictions are
combined in the logistic domain by weights that a gate selects (the decision's kind, how often its longer contexts were
seen); the weights are trained online in every task over all its training text, on counts without the token's own
occurrence, and averaged.  A last stage refines the mixture adaptively: how decisions that got such a prediction came out.

What grows with the corpus is never gathered in one place: blocks of documents send their distinct words, and their
distinct runs of three words, packed by hash bucket, and get back the words' counts and spelling, and what follows two words
elsewhere.  A rare word is spelled once for the whole corpus, in its bucket.  A text's own occurrences never predict it.
"""

from __future__ import annotations

import heapq
import math
import uuid
import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from portflow.llm.blocks import pack_blocks, passed, rows, unpacked
from portflow.llm.common import LOWER, WHITE, written

BLOCK_BYTES = 8 << 20
#: of an Arrow batch of blocks, or of what is exchanged between them, unless one row has more
BATCH_BYTES = 4 << 20
#: stands for the end of a text among the words; no word is white space
END = b"\n"
FOLDS, HELD_OUT = 7, 2
#: words with a code of their own: those seen most often, at least twice; all others are spelled
VOCABULARY = 1 << 16
#: words whose last occurrences are a context of their own
FUNCTION_WORDS = 64
#: most slots of the tables over running text, as powers of two
RUNNING_BITS = (17, 18, 19)
#: spelling contexts: last so many bytes of the word (PREFIX: all its bytes so far)
PREFIX = -1
ORDERS = (1, 2, 3, PREFIX)
#: slots of each spelling context's table, as powers of two
TABLE_BITS = (16, 17, 18, 18)
CHUNK = 1 << 16
#: tables that one task adds up
FAN_IN = 32
WORDS_PER_BUCKET = 125_000
#: two words count as the same if their bucket and 24 more bits of their hash are, the word that follows by 24 bits
RUNS_PER_BUCKET = 1_000_000
SLICE = 1 << 18
#: decisions that are mixed, and learnt from, at a time
STEP = 1 << 15
GATES = 25
PRIOR = 0.4
RATE = 0.03
_M = [np.uint64(pow(0x9E3779B97F4A7C15, 2 * j + 1, 1 << 64)) for j in range(10)]


def held_out(doc_id: int | None) -> bool:
    """By crc32 of the id's digits; a null id trains like an empty string's."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD_OUT


#: 1 for white space, else 0
_WHITE = bytes(c in WHITE for c in range(256))
_PRIME = 0x9E3779B97F4A7C15
_POWERS, _INVERSES = (np.multiply.accumulate(np.full(SLICE, p, np.uint64)) for p in (_PRIME, pow(_PRIME, -1, 1 << 64)))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * _M[3]
    return (x ^ (x >> np.uint64(31))) * _M[4]


_BYTES = _mixed(np.arange(1, 257, dtype=np.uint64))
END_HASH = np.uint64(0x5851F42D4C957F2D)


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words of ``data`` start and end, and a hash of each.

    Sums of bytes times powers, taken over SLICE bytes or one longer word at a time.
    """
    x = np.frombuffer(data, np.uint8)
    white = np.frombuffer(b"\1" + data.translate(_WHITE) + b"\1", np.bool_)
    edges = np.nonzero(white[1:] != white[:-1])[0]
    start, end = edges[::2], edges[1::2]
    out, a = np.empty(len(start), np.uint64), 0
    while a < len(start):
        lo = start[a]
        b = max(a + 1, int(np.searchsorted(end, lo + SLICE, "right")))
        n = int(end[b - 1] - lo)
        powers, inverses = (p[:n] if n <= SLICE else np.multiply.accumulate(np.full(n, p[0])) for p in (_POWERS, _INVERSES))
        total, part = np.zeros(n + 1, np.uint64), _BYTES.take(x[lo:lo + n])
        part *= powers
        np.cumsum(part, out=total[1:])
        s, e = start[a:b] - lo, end[a:b] - lo
        out[a:b] = _mixed((total[e] - total[s]) * inverses[s] + (e - s).astype(np.uint64) * _M[5])
        a = b
    return start, end, out


def hashed(words: list[bytes]) -> np.ndarray:
    """Hashes of words and, at most once among them, the end."""
    out = word_hashes(b" ".join(words))[2]
    return np.insert(out, words.index(END), END_HASH) if len(out) < len(words) else out


def _press(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x).tobytes())


def _press_planes(x: np.ndarray, most: int = 8) -> bytes:
    """Numbers with their bytes sorted by significance, of each the lowest ``most``."""
    return _press(x.view(np.uint8).reshape(len(x), x.dtype.itemsize)[:, :most].T)


def _planes(body: bytes, kind: type, most: int = 8) -> np.ndarray:
    size = np.dtype(kind).itemsize
    found = np.frombuffer(unpacked(body), np.uint8).reshape(min(size, most), -1)
    out = np.zeros((found.shape[1], size), np.uint8)
    out[:, :len(found)] = found.T
    return out.view(kind).ravel()


def grouped(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions by rising hash, equal ones in order, and where a hash differs from the one before.

    Hash and position are sorted as one number, so the hash's lowest bits give way to the position.
    """
    bits = np.uint64(max(1, len(key).bit_length()))
    both = np.sort((key >> bits << bits) | np.arange(len(key), dtype=np.uint64))
    upper = both >> bits
    return (both & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64), np.r_[True, upper[1:] != upper[:-1]]


def distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct hashes, rising, the first position of each, and which of them each position has: ``np.unique``, faster."""
    if not len(key):
        return key, np.zeros(0, np.int64), np.zeros(0, np.int64)
    order, new = grouped(key)
    found = key[order]
    if np.any((found[1:] != found[:-1]) != new[1:]):  # unlike hashes that begin alike
        return np.unique(key, return_index=True, return_inverse=True)
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    return found[new], order[new], which


# --- spelling of rare words: the bit model ----------------------------------------------------------------------------------------------------

def coded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the words' codes laid end to end, and where each code ends."""
    parts = [w if w == END else w + b" " for w in words]
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))


_PATHS = [((np.arange(256, dtype=np.uint64) >> np.uint64(8 - t)) | np.uint64(1 << t)) * _M[9] * _M[1] for t in range(8)]


class Nodes:
    """The distinct beginnings of the words' codes, byte by byte: what a byte's bits are predicted from is one of them.

    ``byte`` is the last byte of each; ``of`` gives, for every byte of ``flat``, its node.
    """

    def __init__(self, flat: np.ndarray, ends: np.ndarray):
        n = len(flat)
        size = np.diff(np.r_[0, ends])
        start = np.repeat(ends - size, size)
        place = np.arange(n) - start
        powers = np.multiply.accumulate(np.full(int(size.max(initial=1)), _M[1]))
        total = np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * powers[place])
        before = np.r_[np.uint64(0), total[:-1]]
        base = before[start]
        _, first, self.of = distinct((total - base) ^ (place.astype(np.uint64) * _M[8]))
        self.byte, place = flat[first], place[first]
        self.contexts = []  # times _M[1], as are the parts of the bits in _PATHS: slots are the highest bits of their sum
        last, so_far = np.zeros(len(first), np.uint64), 0
        for k, order in enumerate(ORDERS):
            if order == PREFIX:
                h = (before - base)[first] + place.astype(np.uint64)
            else:
                for j in range(so_far + 1, order + 1):
                    back = np.where(place >= j, flat[first - np.minimum(place, j)], np.uint8(0x20))
                    last = last * np.uint64(257) + back + np.uint64(1)
                h, so_far = last, order
            h = (h + np.uint64(k + 1)) * _M[2 + k]
            self.contexts.append((h ^ (h >> np.uint64(29))) * _M[1])

    def bits(self) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
        """For each of a byte's bits, highest first: the bits, and the slots of every context."""
        for t in range(8):
            node = _PATHS[t].take(self.byte)
            yield (self.byte >> np.uint8(7 - t)) & np.uint8(1), [((c + node) >> np.uint64(64 - b)).view(np.int64) for c, b in zip(self.contexts, TABLE_BITS)]


def slices(words: list[bytes], most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of words whose codes have about ``most`` bytes."""
    s = size = 0
    for e, w in enumerate(words):
        if e > s and size + len(w) + 1 > most:
            yield s, e
            s, size = e, 0
        size += len(w) + 1
    if s < len(words):
        yield s, len(words)


def empty_tables() -> list[np.ndarray]:
    """counts[slot, bit] of each context."""
    return [np.zeros((1 << b, 2)) for b in TABLE_BITS]


def add_counts(tables: list[np.ndarray], words: list[bytes], count: np.ndarray) -> None:
    for s, e in slices(words):
        flat, ends = coded(words[s:e])
        nodes = Nodes(flat, ends)
        weight = np.tile(np.bincount(nodes.of, np.repeat(count[s:e], np.diff(np.r_[0, ends])), len(nodes.byte)), 8)
        found = [[2 * w + bit for w in where] for bit, where in nodes.bits()]
        for k, t in enumerate(tables):
            t += np.bincount(np.concatenate([where[k] for where in found]), weight, t.size).reshape(t.shape)


class Stretched:
    """What the counts predict, ready to be looked up: by slot, and by slot and bit with an own occurrence left out."""

    def __init__(self, tables: list[np.ndarray]):
        self.whole, self.without, self.seen, self.seen_without = [], [], [], []
        for t in tables:
            zero, one = t[:, 0], t[:, 1]
            self.whole.append(np.log((one + PRIOR) / (zero + PRIOR)).astype(np.float32))
            left = [np.log((one + PRIOR) / (np.maximum(zero - 1, 0) + PRIOR)), np.log((np.maximum(one - 1, 0) + PRIOR) / (zero + PRIOR))]
            self.without.append(np.stack(left, 1).astype(np.float32).ravel())
        for t in tables[-2:]:
            self.seen.append(np.searchsorted([0.5, 3.5, 15.5, 127.5], t.sum(1)).astype(np.int8))
            self.seen_without.append(np.searchsorted([0.5, 3.5, 15.5, 127.5], t.sum(1) - 1).astype(np.int8))

    def inputs(self, where: list[np.ndarray], bit: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
        """Stretched predictions by context, and the gates."""
        seen = self.seen if bit is None else self.seen_without
        gate = (seen[0].take(where[-2], mode="clip") * np.int8(5) + seen[1].take(where[-1], mode="clip")).astype(np.int64)
        if bit is None:
            return [t.take(w, mode="clip") for t, w in zip(self.whole, where)], gate
        return [t.take(2 * w + bit, mode="clip") for t, w in zip(self.without, where)], gate


def mixed(weights: np.ndarray, gate: np.ndarray, x: list[np.ndarray]) -> np.ndarray:
    """The stretched predictions ``x`` by the weights of their gates; sums are taken from the first input on."""
    out = weights[:, 0].take(gate, mode="clip") * x[0]
    for k in range(1, len(x)):
        out += weights[:, k].take(gate, mode="clip") * x[k]
    return out


#: neighbours are summed in as many separate sums, as an addition needn't wait for the one before then
LANES = 4


def lanes(gate: np.ndarray) -> np.ndarray:
    out = gate * LANES
    for k in range(1, LANES):
        out[k::LANES] += k
    return out


def lane_sums(lane: np.ndarray, x: np.ndarray, gates: int) -> np.ndarray:
    """Sums of ``x`` by gate."""
    return np.bincount(lane, x, gates * LANES).reshape(gates, LANES).sum(1)


def train(tables: Stretched, words: list[bytes], count: np.ndarray, weights: np.ndarray, scale: np.ndarray) -> None:
    """Online steps over the words' bits; ``weights`` and ``scale`` (sums of squared steps) are updated in place."""
    for s, e in slices(words):
        flat, ends = coded(words[s:e])
        nodes = Nodes(flat, ends)
        times = np.minimum(np.bincount(nodes.of, np.repeat(count[s:e], np.diff(np.r_[0, ends])), len(nodes.byte)), 64)
        for bit, where in nodes.bits():
            x, gate = tables.inputs(where, bit)
            z = mixed(weights, gate, x)
            step = (bit - 1 / (1 + np.exp(-np.clip(z, -20, 20)))) * times
            lane = lanes(gate)
            total = lane_sums(lane, times, GATES) + 1
            for k in range(len(x)):
                g = lane_sums(lane, step * x[k], GATES) / total
                scale[:, k] += g * g
                weights[:, k] += RATE * g / np.sqrt(scale[:, k] + 1e-8)


def log_probability(tables: Stretched, weights: np.ndarray, words: list[bytes]) -> np.ndarray:
    """Natural logarithm of each word's probability by its bits."""
    out = np.zeros(len(words))
    for s, e in slices(words):
        flat, ends = coded(words[s:e])
        nodes = Nodes(flat, ends)
        total = np.zeros(len(nodes.byte))
        for bit, where in nodes.bits():
            x, gate = tables.inputs(where)
            z = np.clip(mixed(weights, gate, x), -20, 20)
            total -= np.log1p(np.exp(np.where(bit > 0, -z, z)))
        out[s:e] = np.add.reduceat(total[nodes.of], np.r_[0, ends[:-1]])
    return out


# --- tokens -----------------------------------------------------------------------------------------------------------

class Tokens:
    """A block's tokens: ``hashes`` of the distinct words, rising, ``at`` (which word each token is), ``doc`` and ``starts`` of the texts."""

    def __init__(self, row: dict):
        text, at, docs = unpacked(row["body"]).translate(LOWER), 0, []
        for n in row["sizes"]:
            docs.append(text[at:at + n])
            at += n
        self.data = b" ".join(docs)
        begin = np.cumsum([0, *(n + 1 for n in row["sizes"][:-1])])
        self.start, self.end, hashes = word_hashes(self.data)
        self.size = np.diff(np.searchsorted(self.start, np.r_[begin, len(self.data) + 1])) + 1
        doc = np.repeat(np.arange(len(docs)), self.size - 1)
        self.starts = np.cumsum(self.size) - self.size
        self.doc = np.repeat(np.arange(len(docs)), self.size)
        self.token = np.full(len(self.doc), END_HASH)
        self.token[np.arange(len(hashes)) + doc] = hashes
        self.train = ~np.fromiter(map(held_out, row["ids"]), bool, len(docs))
        self.before = _mixed(back(self.token, self.starts, 1) + back(self.token, self.starts, 2) * _M[5])

    @cached_property
    def _distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return distinct(self.token)

    @property
    def hashes(self) -> np.ndarray:
        return self._distinct[0]

    @property
    def first(self) -> np.ndarray:
        return self._distinct[1]

    @property
    def at(self) -> np.ndarray:
        return self._distinct[2]

    def joined(self) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the distinct words by rising hash, a space after each, and where they end with it."""
        k = self.first - self.doc[self.first]
        end = self.token[self.first] == END_HASH
        k[end] = -1
        start, size = np.r_[self.start, 0][k], np.r_[self.end - self.start, 1][k] + 1
        reach = np.cumsum(size)
        at = np.repeat(start - (reach - size), size)
        at += np.arange(len(at))
        out = np.frombuffer(self.data or b" ", np.uint8).take(at, mode="clip")
        out[reach - 1] = 0x20
        out[reach[end] - 2] = END[0]
        return out, reach

    def words(self) -> list[bytes]:
        """The distinct words by rising hash."""
        return _words(self.joined()[0].tobytes()[:-1])


def back(x: np.ndarray, starts: np.ndarray, by: int) -> np.ndarray:
    """``x`` of the position ``by`` earlier in the same text, else 0."""
    out = np.r_[np.zeros(by, x.dtype), x[:-by]][:len(x)]
    for j in range(by):
        out[np.minimum(starts + j, len(x) - 1)[starts + j < len(x)]] = 0
    return out


def recent(outcome: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last four and the last eight outcomes in the same text, two bits each from the third bit on, the last one lowest."""
    at = np.arange(len(doc)) + 8 * (doc + 1)  # texts are set apart by eight zeros
    x = np.zeros(int(at[-1]) + 1 if len(at) else 1, np.uint32)
    x[at] = outcome
    for reach in (1, 2, 4, 8):
        if reach == 1:
            x[1:] = x[:-1] << np.uint32(2)
            x[0] = 0
        else:
            x[reach // 2:] += x[:-(reach // 2)] << np.uint32(reach)
        if reach == 4:
            short = x[at]
    return short, x[at]


# --- exchange of words: counts, vocabulary, spelling -----------------------------------------------------------------

_WORDS = T.StructType([T.StructField("key", T.LongType()), T.StructField("block", T.StringType()), T.StructField("words", T.BinaryType()), T.StructField("counts", T.BinaryType())])
#: ``places``: which of the bucket's words each block has; ``sizes``: how many
_LEXICON = T.StructType([T.StructField("key", T.LongType()), T.StructField("words", T.BinaryType()), T.StructField("counts", T.BinaryType()), T.StructField("tokens", T.LongType()),
                         T.StructField("distinct", T.LongType()), T.StructField("bins", T.ArrayType(T.LongType())), T.StructField("blocks", T.ArrayType(T.StringType())),
                         T.StructField("sizes", T.ArrayType(T.LongType())), T.StructField("places", T.BinaryType())])
_FREQUENT = T.StructType([T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())])
_TABLES = T.StructType([T.StructField("key", T.LongType()), T.StructField("part", T.LongType()), T.StructField("body", T.BinaryType())])
_WORD_REPLY = T.StructType([T.StructField("key", T.LongType()), T.StructField("block", T.StringType()), T.StructField("counts", T.BinaryType()), T.StructField("spelled", T.BinaryType())])
#: counts of words are sorted into so many bins per doubling
BINS = 16


def _split(words: bytes) -> list[bytes]:
    return _words(unpacked(words))


def _words(joined: bytes) -> list[bytes]:
    return joined.split(b" ")


def _word_pass(bits: int):
    """A block's distinct words with their training counts, by rising hash, a row for each bucket."""
    def sent(row: dict) -> dict:
        t = Tokens(row)
        (words, reach), counts = t.joined(), np.bincount(t.at[t.train[t.doc]], minlength=len(t.hashes))
        bucket = (t.hashes >> np.uint64(64 - bits)).astype(np.int64)
        cut = np.r_[np.nonzero(np.r_[True, bucket[1:] != bucket[:-1]])[0], len(bucket)].tolist()
        return {"key": bucket[cut[:-1]], "block": [row["block"]] * (len(cut) - 1), "words": [_press(words[reach[s - 1] if s else 0:reach[e - 1] - 1]) for s, e in zip(cut, cut[1:])],
                "counts": [_press_planes(counts[s:e]) for s, e in zip(cut, cut[1:])]}

    return lambda batches: map(sent, rows(batches))


def _merge(part: pa.Table) -> pa.Table:
    """A bucket's distinct words of all blocks, by rising hash, with their training counts and where each block has them."""
    bodies = [_split(x) for x in part.column("words").to_pylist()]
    words, hashes = [w for body in bodies for w in body], np.concatenate([hashed(body) for body in bodies])
    counts = np.concatenate([_planes(x, np.int64) for x in part.column("counts").to_pylist()])
    order = np.argsort(hashes)
    new = np.r_[True, hashes[order[1:]] != hashes[order[:-1]]]
    first, place = np.nonzero(new)[0], np.empty(len(order), np.uint32)
    place[order] = np.cumsum(new) - 1
    total = np.add.reduceat(counts[order], first)
    bins = np.bincount((np.log2(total[total > 0]) * BINS).astype(np.int64), minlength=1).tolist()
    return pa.table({"key": part.column("key")[:1], "words": pa.array([_press(np.frombuffer(b" ".join(words[k] for k in order[first].tolist()), np.uint8))], pa.binary()),
                     "counts": pa.array([_press_planes(total)], pa.binary()), "tokens": pa.array([int(total.sum())]), "distinct": pa.array([int((total > 0).sum())]),
                     "bins": pa.array([bins], pa.list_(pa.int64())), "blocks": pa.array([part.column("block").to_pylist()], pa.list_(pa.string())),
                     "sizes": pa.array([list(map(len, bodies))], pa.list_(pa.int64())), "places": pa.array([_press_planes(np.diff(place, prepend=np.uint32(0)))], pa.binary())},
                    schema=to_arrow_schema(_LEXICON))


def _frequent_pass(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for row in rows(batches):
            words, counts = _split(row["words"]), _planes(row["counts"], np.int64)
            keep = [k for k in np.nonzero(counts)[0].tolist() if words[k] == END or int(np.log2(counts[k]) * BINS) >= least]
            yield {"word": [words[k] for k in keep], "n": counts[keep]}
    return run


#: of a hash: what the table of ``Code.sure_symbols`` is looked up by
DIRECT_BITS = 20


class Code:
    """Huffman code of the frequent words and the escape, symbol 0; more frequent words have smaller symbols."""

    def __init__(self, counts: dict[bytes, int], tokens: int):
        words = sorted(counts, key=lambda w: (-counts[w], w))
        hashes = hashed(words)
        order = np.argsort(hashes)
        self.hashes, self.symbol = hashes[order], (order + 1).astype(np.int64)
        weight = [max(1, tokens - sum(counts.values())), *(counts[w] for w in words)]
        heap, below = [(n, k) for k, n in enumerate(weight)], {}
        heapq.heapify(heap)
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            k = len(weight) + len(below)
            below[k] = (a[1], b[1])
            heapq.heappush(heap, (a[0] + b[0], k))
        paths, todo = [()] * len(weight), [(heap[0][1], ())]
        while todo:
            k, path = todo.pop()
            if k in below:
                todo += [(child, (*path, 2 * (k - len(weight)) + bit)) for bit, child in enumerate(below[k])]
            else:
                paths[k] = path
        self.size = np.fromiter(map(len, paths), np.int64, len(paths))
        self.start = np.cumsum(self.size) - self.size
        flat = np.fromiter((x for path in paths for x in path), np.int64, int(self.size.sum()))
        self.node, self.bit, self.nodes = (flat >> 1).astype(np.uint64), (flat & 1).astype(np.uint8), len(below)

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.symbol[at], 0)

    @cached_property
    def step(self) -> np.ndarray:
        """What a path's nodes add to a hashed context."""
        return self.node * _M[9] * _M[1]

    @cached_property
    def by_symbol(self) -> np.ndarray:
        out = np.zeros(len(self.hashes) + 1, np.uint64)
        out[self.symbol] = self.hashes
        return out

    @cached_property
    def prefix(self) -> np.ndarray:
        """24 bits of the hash by symbol."""
        return (self.by_symbol >> np.uint64(40)).astype(np.uint32)

    @cached_property
    def _direct(self) -> np.ndarray:
        out = np.zeros(1 << DIRECT_BITS, np.uint32)
        out[self.hashes >> np.uint64(64 - DIRECT_BITS)] = self.symbol
        return out

    def sure_symbols(self, hashes: np.ndarray) -> np.ndarray:
        """Symbols in two look-ups; a frequent word may get none (0) if another one's hash begins alike."""
        at = self._direct.take((hashes >> np.uint64(64 - DIRECT_BITS)).view(np.int64), mode="clip")
        return np.where(self.by_symbol.take(at) == hashes, at, np.uint32(0))


def vocabulary(lexicon: DataFrame, tokens: int) -> Code:
    """At most VOCABULARY words (and the end) reach the driver: whole bins of counts, from the largest down."""
    bins = {r["k"]: r["n"] for r in lexicon.select(F.posexplode("bins").alias("k", "n")).groupBy("k").agg(F.sum("n").alias("n")).collect()}
    least, room = max(bins, default=0) + 1, VOCABULARY
    while least > BINS and bins.get(least - 1, 0) <= room:
        least -= 1
        room -= bins.get(least, 0)
    found = passed(lexicon.select("words", "counts"), _frequent_pass(least), _FREQUENT).collect()
    return Code({bytes(r["word"]): r["n"] for r in found}, tokens)


def _chunks(tables: list[np.ndarray]) -> Iterator[dict]:
    from pyspark import TaskContext
    flat, part = np.concatenate([t.ravel() for t in tables]), TaskContext.get().partitionId()
    for k in range(0, len(flat), CHUNK):
        yield {"key": [k // CHUNK], "part": [part], "body": [_press_planes(flat[k:k + CHUNK])]}


def _add_chunks(part: pa.Table) -> pa.Table:
    total = np.zeros(CHUNK)
    for body in part.column("body").to_pylist():
        x = _planes(body, np.float64)
        total[:len(x)] += x
        n = len(x)
    return pa.table({"key": part.column("key")[:1], "part": part.column("part")[:1], "body": pa.array([_press_planes(total[:n])])}, schema=to_arrow_schema(_TABLES))


def context_tables(partial: DataFrame, bits: tuple[int, ...]) -> list[np.ndarray]:
    """Counts over all training text.  The tables' size is bounded; the tasks' tables are added FAN_IN at a time."""
    parts = partial.rdd.getNumPartitions()  # of the plan: the pass itself runs once
    while True:
        parts = max(1, math.ceil(parts / FAN_IN))
        partial = partial.withColumn("part", F.pmod(F.xxhash64("part"), F.lit(parts)))
        partial = written(partial.groupBy("key", "part").applyInArrow(_add_chunks, _TABLES), "context_counts")
        if parts == 1:
            break
    flat = [_planes(bytes(r["body"]), np.float64) for r in sorted(partial.collect(), key=lambda r: r["key"])]
    if not flat:
        return [np.zeros((1 << b, 2), np.float32) for b in bits]
    cut = np.cumsum([2 << b for b in bits])
    return [t.reshape(-1, 2).astype(np.float32) for t in np.split(np.concatenate(flat), cut[:-1])]


_READY: dict[str, object] = {}


class Shared:
    """A broadcast that each worker makes ready once."""

    def __init__(self, spark, value, ready=None):
        self.id, self.broadcast, self.ready = uuid.uuid4().hex, spark.sparkContext.broadcast(value), ready

    @property
    def value(self):
        if self.id not in _READY:
            if len(_READY) > 3:
                _READY.clear()
            _READY[self.id] = self.ready(self.broadcast.value) if self.ready else self.broadcast.value
        return _READY[self.id]


def _rare(row: dict, code: Code) -> tuple[list[bytes], np.ndarray]:
    """A bucket's words that training texts have and the vocabulary hasn't, and their counts."""
    words, counts = _split(row["words"]), _planes(row["counts"], np.int64)
    rare = np.nonzero((code.symbols(hashed(words)) == 0) & (counts > 0))[0]
    return [words[k] for k in rare.tolist()], counts[rare]


def _spelling_pass(code: Shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        tables, any_ = empty_tables(), False
        for row in rows(batches):
            words, counts = _rare(row, code.value)
            add_counts(tables, words, counts)
            any_ = any_ or bool(words)
        if any_:
            yield from _chunks(tables)
    return run


_WEIGHTS = T.StructType([T.StructField("gate", T.LongType()), T.StructField("input", T.LongType()), T.StructField("weight", T.DoubleType()),
                         T.StructField("used", T.BooleanType()), T.StructField("seen", T.LongType())])


def _weight_rows(weights: np.ndarray, scale: np.ndarray, seen: int) -> dict:
    gates, inputs = weights.shape
    return {"gate": np.repeat(np.arange(gates), inputs), "input": np.tile(np.arange(inputs), gates), "weight": weights.ravel(), "used": scale.ravel() > 0,
            "seen": np.full(weights.size, seen)}


def _spelling_train_pass(code: Shared, tables: Shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        weights, scale, seen = np.full((GATES, len(ORDERS)), 0.3), np.zeros((GATES, len(ORDERS))), 0
        for row in rows(batches):
            words, counts = _rare(row, code.value)
            train(tables.value, words, counts, weights, scale)
            seen += int(counts.sum())
        if seen:
            yield _weight_rows(weights, scale, seen)
    return run


def averaged(found: DataFrame, gates: int, inputs: int) -> np.ndarray:
    """Weights trained online in every task over all its text, averaged by what the tasks have seen."""
    mean = F.sum(F.col("weight") * F.col("seen")) / F.sum("seen")
    out = np.full((gates, inputs), 0.3)
    for r in found.where("used").groupBy("gate", "input").agg(mean.alias("w")).collect():
        out[r["gate"], r["input"]] = r["w"]
    return out


def _answer_words(code: Shared, tables: Shared, weights: np.ndarray):
    """Each block's words get their training counts and the log probabilities of the rare ones' spelling."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for row in rows(batches):
            words, counts = _split(row["words"]), _planes(row["counts"], np.int64)
            rare = np.nonzero(code.value.symbols(hashed(words)) == 0)[0]
            spelled = np.zeros(len(words), np.float32)
            spelled[rare] = np.rint(64 * log_probability(tables.value, weights, [words[k] for k in rare.tolist()])) / 64
            found = np.split(np.cumsum(_planes(row["places"], np.uint32), dtype=np.uint32), np.cumsum(row["sizes"])[:-1])
            yield {"key": [row["key"]] * len(found), "block": row["blocks"], "counts": [_press_planes(counts[at]) for at in found],
                   "spelled": [_press_planes(spelled[at]) for at in found]}
    return run


# --- exchange of runs of three words ----------------------------------------------------------------------------------

_RUNS = T.StructType([T.StructField("key", T.LongType()), T.StructField("block", T.StringType()), T.StructField("before", T.BinaryType()), T.StructField("word", T.BinaryType()),
                      T.StructField("rare", T.BinaryType()), T.StructField("own", T.BinaryType()), T.StructField("counts", T.BinaryType())])
_RUN_REPLY = T.StructType([T.StructField("key", T.LongType()), T.StructField("block", T.StringType()), T.StructField("body", T.BinaryType())])


def runs(t: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The runs (two words before, word, how often this text trains on it) of a block, by rising hash of the two words.

    Returns a position of each, the text's own count, how many training positions there are, and for each position which
    run it is.  Neighbouring texts with the same count share one.
    """
    order, new = grouped((t.before >> np.uint64(34) << np.uint64(34)) | (_mixed(t.before ^ (t.token * _M[6])) >> np.uint64(30)))
    doc = t.doc[order]
    first = np.nonzero(new | np.r_[True, doc[1:] != doc[:-1]])[0]
    times = np.diff(np.r_[first, len(order)])
    own = np.where(t.train[doc[first]], times, 0)
    begin = new[first] | np.r_[True, own[1:] != own[:-1]]
    at = np.nonzero(begin)[0]
    which = np.empty(len(order), np.int64)
    which[order] = np.repeat(np.cumsum(begin) - 1, times)
    return order[first[at]], own[at], np.add.reduceat(own, at), which


def _run_pass(bits: int, code: Shared | None = None):
    """A block's runs by bucket.  A word goes as its symbol, which takes less room than its hash; one without (0) by its hash."""
    def sent(row: dict) -> dict:
        t = Tokens(row)
        at, own, n, _ = runs(t)
        before, token = t.before[at], t.token[at]
        del t
        symbol, word = code.value.sure_symbols(token) if code else np.zeros(len(token), np.uint32), (token >> np.uint64(40)).astype(np.uint32)
        bucket, low = (before >> np.uint64(64 - bits)).astype(np.int64), ((before << np.uint64(bits)) >> np.uint64(40)).astype(np.uint32)
        cut = np.r_[np.nonzero(np.r_[True, bucket[1:] != bucket[:-1]])[0], len(bucket)].tolist()
        spans = list(zip(cut, cut[1:]))
        return {"key": bucket[cut[:-1]], "block": [row["block"]] * len(spans), "before": [_press_planes(np.diff(low[s:e], prepend=np.uint32(0)), 3) for s, e in spans],
                "word": [_press_planes(symbol[s:e], 3) for s, e in spans], "rare": [_press_planes(word[s:e][symbol[s:e] == 0], 3) for s, e in spans], "own": [_press_planes(own[s:e]) for s, e in spans], "counts": [_press_planes(n[s:e]) for s, e in spans]}

    return lambda batches: map(sent, rows(batches))


#: least counts of the levels of how often the word expected was seen, and how often another one
SURE, UNSURE = (1, 2, 3, 5, 9, 17, 65), (1, 3, 9)


def expected(before: np.ndarray, word: np.ndarray, own: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether each run ends in the word expected elsewhere (bit 0), levels of its count (bits 1-3) and of the others' (4-5).

    Expected is the word seen most often after the two words in all training texts but the run's own; the smaller hash
    wins a tie.  0: nothing was seen.
    """
    both = before.astype(np.uint64) << np.uint64(32) | word
    order = np.argsort(both, kind="stable")
    new = np.r_[True, both[order[1:]] != both[order[:-1]]]
    start = np.nonzero(new)[0]
    pair = np.empty(len(both), np.int64)
    pair[order] = np.cumsum(new) - 1
    total, context = np.add.reduceat(n[order], start), both[order[start]] >> np.uint64(32)
    first = np.nonzero(np.r_[True, context[1:] != context[:-1]])[0]
    size = np.diff(np.r_[first, len(total)])
    low = np.uint64(0xFFFFFFFF)
    rank = (total.astype(np.uint64) << np.uint64(32)) | (low - np.arange(len(total), dtype=np.uint64))
    best = (low - (np.maximum.reduceat(rank, first) & low)).astype(np.int64)
    rank[best] = 0
    second = np.where(size > 1, (low - (np.maximum.reduceat(rank, first) & low)).astype(np.int64), -1)
    sums, g = np.add.reduceat(total, first), np.repeat(np.arange(len(first)), size)[pair]
    rival = np.where(best[g] == pair, second[g], best[g])
    rivals, mine = np.where(rival >= 0, total[rival], 0), total[pair] - own
    hit = (mine > rivals) | ((mine == rivals) & (mine > 0) & (pair < rival))
    most = np.maximum(mine, rivals)
    out = hit | np.searchsorted(SURE, most, "right") << 1 | np.searchsorted(UNSURE, sums[g] - own - most, "right") << 4
    return np.where(most > 0, out, 0).astype(np.uint8)


def _answer_runs(code: Shared):
    def run(part: pa.Table) -> pa.Table:
        before = [np.cumsum(_planes(x, np.uint32, 3), dtype=np.uint32) & np.uint32(0xFFFFFF) for x in part.column("before").to_pylist()]
        symbol, rare = (np.concatenate([_planes(x, np.uint32, 3) for x in part.column(c).to_pylist()]) for c in ("word", "rare"))
        word = code.value.prefix.take(symbol)
        word[symbol == 0] = rare
        own, n = (np.concatenate([_planes(x, np.int64) for x in part.column(c).to_pylist()]) for c in ("own", "counts"))
        out, cut = expected(np.concatenate(before), word, own, n), np.cumsum([0, *map(len, before)]).tolist()
        return pa.table({"key": part.column("key"), "block": part.column("block"), "body": pa.array([_press(out[s:e]) for s, e in zip(cut, cut[1:])], pa.binary())}, schema=to_arrow_schema(_RUN_REPLY))
    return run


# --- the running text -------------------------------------------------------------------------------------------------

_STREAM = T.StructType([T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("sizes", T.ArrayType(T.LongType())), T.StructField("n_tokens", T.ArrayType(T.LongType())),
                        T.StructField("n_known", T.ArrayType(T.LongType())), T.StructField("base_score", T.ArrayType(T.DoubleType())),
                        *(T.StructField(c, T.BinaryType()) for c in ("at", "word", "symbol", "spelled", "flags"))])


def repeated(key: np.ndarray) -> np.ndarray:
    """The last earlier position with the same key, else -1."""
    order, new = grouped(key)
    out = np.full(len(key), -1)
    same = np.nonzero(~new)[0]
    out[order[same]] = order[same - 1]
    return out


def _stream_pass(code: Shared, tokens: int, v: int):
    """Blocks as arrays: which word each token is, the words' hashes, symbols and spelling, and what was expected."""
    def told(row: dict) -> dict:
        t = Tokens(row)
        replies = sorted(row["word_replies"], key=lambda r: r["key"])
        count = np.concatenate([_planes(r["counts"], np.int64) for r in replies])
        spelled = np.concatenate([_planes(r["spelled"], np.float32) for r in replies])
        flags = np.concatenate([np.frombuffer(unpacked(r["body"]), np.uint8) for r in sorted(row["run_replies"], key=lambda r: r["key"])])[runs(t)[3]]
        last = repeated(_mixed(t.before + t.doc.astype(np.uint64) * _M[8]))
        again = np.where(last >= 0, 1 + (t.at[last] == t.at), 0).astype(np.uint8)
        base = np.log10((count + 1) / (tokens + v + 1))[t.at]
        order = np.argsort(-np.bincount(t.at, minlength=len(t.hashes)), kind="stable")  # small numbers for the block's frequent words
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order))
        return {"ids": [row["ids"]], "sizes": [row["sizes"]], "n_tokens": [t.size], "n_known": [np.add.reduceat((count > 0)[t.at].astype(np.int64), t.starts)],
               "base_score": [np.add.reduceat(base, t.starts)], "at": [_press_planes(place[t.at])],
               "word": [_press((t.hashes >> np.uint64(48)).astype(np.uint16)[order])], "symbol": [_press_planes(code.value.symbols(t.hashes).astype(np.uint32)[order])],
               "spelled": [_press_planes(spelled[order])], "flags": [_press(flags | again << 6)]}

    return lambda batches: map(told, rows(batches))


TREE, CORPUS, OWN, AGAIN = range(4)
KINDS = 4


class Stream:
    """A block's decisions.  ``base``: natural log probability of what isn't decided by bits, by token."""

    def __init__(self, row: dict, code: Code):
        self.code, self.size = code, np.array(row["n_tokens"], np.int64)
        self.starts = np.cumsum(self.size) - self.size
        starts = self.starts
        doc = np.repeat(np.arange(len(self.size)), self.size)
        self.train = np.repeat(~np.fromiter(map(held_out, row["ids"]), bool, len(self.size)), self.size)
        at, flags = _planes(row["at"], np.uint32).astype(np.int64), np.frombuffer(unpacked(row["flags"]), np.uint8)
        word = np.frombuffer(unpacked(row["word"]), np.uint16).astype(np.uint64)[at]
        self.symbol = _planes(row["symbol"], np.uint32).astype(np.int64)[at]
        n = len(at)
        sure, hit, own = flags & 62, (flags & 1).astype(bool), flags >> 6
        outcome = np.where(hit, 1, np.where(own == 2, 2, np.where((sure > 0) | (own == 1), 3, 0))).astype(np.uint8)
        short, long = recent(outcome, doc)
        before = back(word, starts, 1)
        frequent = np.where((self.symbol > 0) & (self.symbol <= FUNCTION_WORDS), np.arange(n), -1)
        near = np.r_[-1, np.maximum.accumulate(frequent)[:-1]] if n else frequent
        near = np.where(near >= starts[doc], near, -1)
        f1 = np.where(near >= 0, self.symbol[near], 0).astype(np.uint64)
        f2 = np.where(near >= 0, f1[near], np.uint64(0))
        # hashed contexts are kept times _M[1], as are Code.step and the nodes in decisions(): slots are the highest bits of their sum
        contexts = [x * _M[1] for x in (_mixed(f1 + np.uint64(1)), _mixed(f1 * np.uint64(FUNCTION_WORDS + 1) + f2 + np.uint64(977)), _mixed(before + np.uint64(3)))]
        sure64 = sure.astype(np.uint64)
        flagged = [_mixed((x.astype(np.uint64) << np.uint64(8)) + sure64 + np.uint64(c)) * _M[1] for x, c in ((short, 5), (long, 11))] + [contexts[2]]
        todo = np.ones(n, bool)
        self.parts = []
        asked = np.nonzero(sure > 0)[0]
        self.parts.append((CORPUS, asked, hit[asked], flagged))
        todo &= ~(hit & (sure > 0))
        asked = np.nonzero(todo & (own > 0))[0]
        self.parts.append((OWN, asked, own[asked] == 2, flagged))
        todo &= own != 2
        self.tree = todo
        rare = np.nonzero(todo & (self.symbol == 0))[0]
        self.base = np.zeros(n)
        if len(rare):
            spelled = _planes(row["spelled"], np.float32)[at[rare]].astype(np.float64)
            d = doc[rare]
            earlier = np.arange(len(rare)) - np.searchsorted(d, d)
            known = repeated(_mixed(at[rare].astype(np.uint64) + d.astype(np.uint64) * _M[8])) >= 0
            self.base[rare] = np.where(known, -np.log(np.maximum(earlier, 1)), spelled)
            level = np.zeros(n, np.uint64)
            level[rare] = np.log2(earlier + 1).astype(np.uint64)
            asked = rare[earlier > 0]
            self.parts.append((AGAIN, asked, known[earlier > 0], [_mixed(level + np.uint64(13)) * _M[1], _mixed(level * np.uint64(97) + f1 + np.uint64(17)) * _M[1], contexts[2]]))
        self.contexts = contexts

    def decisions(self, which: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[np.ndarray]]]:
        """Kind, tokens, bits and hashed contexts of STEP or a little more decisions at a time, of the tokens in ``which``."""
        for kind, tokens, size, bit, hashes in self.steps(which):
            yield kind, tokens if size is None else np.repeat(tokens, size), bit, hashes

    def steps(self, which: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray | None, np.ndarray, list[np.ndarray]]]:
        """As ``decisions``, each token once with how many decisions it has (None: one)."""
        code = self.code
        for kind, asked, bit, contexts in self.parts:
            keep = which[asked]
            asked, bit = asked[keep], bit[keep].astype(np.uint8)
            node = np.array([code.nodes + kind], np.uint64) * _M[9] * _M[1]
            for s in range(0, len(asked), STEP):
                at = asked[s:s + STEP]
                yield kind, at, None, bit[s:s + STEP], [c.take(at) + node for c in contexts]
        tokens = np.nonzero(which & self.tree)[0]
        symbol = self.symbol[tokens]
        start, size = code.start[symbol], code.size[symbol]
        reach = np.cumsum(size)
        s = 0
        while s < len(tokens):
            e = max(s + 1, int(np.searchsorted(reach, (reach[s - 1] if s else 0) + STEP)))
            own, k = tokens[s:e], size[s:e]
            path = np.repeat(start[s:e] - (reach[s:e] - k - (reach[s - 1] if s else 0)), k)
            path += np.arange(len(path))
            node = code.step.take(path, mode="clip")
            hashes = []
            for c in self.contexts:
                h = np.repeat(c.take(own), k)
                h += node
                hashes.append(h)
            yield TREE, own, k, code.bit.take(path, mode="clip"), hashes
            s = e


class Mixer:
    """Stretched predictions of the tables over running text: of all counts, and by a training token's bit without its own."""

    def __init__(self, tables: list[np.ndarray]):
        self.shift = [np.uint64(64 - (len(t).bit_length() - 1)) for t in tables]
        self.whole, self.without, self.seen = [], [], []
        for t in tables:
            zero, one = t[:, 0], t[:, 1]
            less0, less1 = np.maximum(zero - 1, 0), np.maximum(one - 1, 0)
            self.whole.append(np.log((one + PRIOR) / (zero + PRIOR)).astype(np.float32))
            self.without.append(np.log(np.stack([(one + PRIOR) / (less0 + PRIOR), (less1 + PRIOR) / (zero + PRIOR)], 1)).astype(np.float32).ravel())
            self.seen.append(np.searchsorted([0.5, 3.5, 15.5, 127.5], zero + one).astype(np.uint8))
        self.without = np.split(np.concatenate(self.without), np.cumsum([2 * len(t) for t in tables])[:-1])  # of one array, which gets large pages

    def inputs(self, hashes: list[np.ndarray], bit: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
        """Inputs by context, and the gates within a kind; with ``bit`` those of training tokens."""
        slots = [(h >> s).view(np.int64) for h, s in zip(hashes, self.shift)]
        n = len(slots)
        gate = (self.seen[n - 2].take(slots[-2], mode="clip") * np.uint8(5) + self.seen[n - 1].take(slots[-1], mode="clip")).astype(np.int64)
        if bit is None:
            return [t.take(at, mode="clip") for t, at in zip(self.whole, slots)], gate
        out = []
        for t, at in zip(self.without, slots):
            at *= 2
            at += bit
            out.append(t.take(at, mode="clip"))
        return out, gate


#: steps of the last stage between stretched predictions -8 and 8
STEPS = 33


def _refine_place(z: np.ndarray, gate: np.ndarray) -> np.ndarray:
    place = z + z.dtype.type(8)
    place *= 2
    np.clip(np.rint(place, out=place), 0, STEPS - 1, out=place)
    out = place.astype(np.int64)
    out += gate * STEPS
    return out


def learn(mixer: Mixer, stream: Stream, weights: np.ndarray, scale: np.ndarray, came: np.ndarray) -> None:
    """Online steps over the training tokens' decisions; ``weights``, ``scale`` and ``came`` (outcomes by the last stage's place) change."""
    for kind, _, _, bit, hashes in stream.steps(stream.train):
        lo, hi = GATES * kind, GATES * (kind + 1)
        x, gate = mixer.inputs(hashes, bit)
        z = mixed(weights[lo:hi].astype(np.float32), gate, x)
        place = _refine_place(z, gate)
        place *= 2
        place += bit
        now = np.bincount(place, minlength=2 * GATES * STEPS).reshape(-1, 2)
        came[STEPS * lo:STEPS * hi] += now
        np.negative(np.clip(z, -20, 20, out=z), out=z)
        np.exp(z, out=z)
        z += 1
        step = bit - 1 / z
        lane = lanes(gate)
        total = now.reshape(GATES, -1).sum(1) + 1
        for k in range(len(x)):
            g = lane_sums(lane, step * x[k], GATES) / total
            scale[lo:hi, k] += g * g
            weights[lo:hi, k] += RATE * g / np.sqrt(scale[lo:hi, k] + 1e-8)


def refined(came: np.ndarray) -> np.ndarray:
    """Share of ones at each place of the last stage; where little was seen it stays near the prediction itself."""
    centre = 1 / (1 + np.exp(8 - np.arange(STEPS) / 2))
    centre = np.tile(centre, len(came) // STEPS)
    return (came[:, 1] + 16 * centre) / (came.sum(1) + 16)


def log_probabilities(mixer: Mixer, stream: Stream, weights: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Natural log probability of each token; training tokens are predicted without their own occurrence."""
    out, weights, last = stream.base.copy(), weights.astype(np.float32), last.astype(np.float32) * np.float32(0.5)
    for train in (True, False):
        for kind, tokens, size, bit, hashes in stream.steps(stream.train == train):
            if not len(bit):  # a code of nothing but the escape
                continue
            lo, hi = GATES * kind, GATES * (kind + 1)
            x, gate = mixer.inputs(hashes, bit if train else None)
            z = mixed(weights[lo:hi], gate, x)
            np.clip(z, -12, 12, out=z)
            place = _refine_place(z, gate)
            np.exp(np.negative(z, out=z), out=z)
            z += 1
            one = np.float32(0.5) / z
            one += last[STEPS * lo:STEPS * hi].take(place, mode="clip")
            one -= 1 - bit
            log = np.log(np.abs(one, out=one)).astype(np.float64)  # of one, or of 1 - one
            out[tokens] += log if size is None else np.add.reduceat(log, np.cumsum(size) - size)
    return out


def _table_pass(code: Shared, bits: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        tables, any_ = [np.zeros(2 << b) for b in bits], False
        for row in rows(batches):
            stream = None  # the last block's arrays go before the next one's are made
            stream, any_ = Stream(row, code.value), True
            held, n = [[] for _ in bits], 0
            for _, _, _, bit, hashes in stream.steps(stream.train):
                for k, b in enumerate(bits):
                    at = (hashes[k] >> np.uint64(64 - b)).view(np.int64)
                    at *= 2
                    at += bit
                    held[k].append(at)
                n += len(bit)
                if n > 1 << 20:
                    _add(tables, held)
                    held, n = [[] for _ in bits], 0
            _add(tables, held)
        if any_:
            yield from _chunks(tables)
    return run


def _add(tables: list[np.ndarray], held: list[list[np.ndarray]]) -> None:
    for t, slots in zip(tables, held):
        if slots:
            t += np.bincount(np.concatenate(slots), minlength=len(t))


_LEARNT = T.StructType([T.StructField("learnt", T.ArrayType(_WEIGHTS)), T.StructField("came", T.ArrayType(T.LongType()))])


def _learn_pass(code: Shared, mixer: Shared, inputs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        gates = GATES * KINDS
        weights, scale, came, seen = np.full((gates, inputs), 0.3), np.zeros((gates, inputs)), np.zeros((gates * STEPS, 2), np.int64), 0
        for row in rows(batches):
            stream = None
            stream = Stream(row, code.value)
            learn(mixer.value, stream, weights, scale, came)
            seen += int(stream.train.sum())
        if seen:
            cols = _weight_rows(weights, scale, seen)
            yield {"learnt": [[dict(zip(cols, r)) for r in zip(*(np.asarray(c).tolist() for c in cols.values()))]], "came": [came.ravel()]}
    return run


def mixing(stream: DataFrame, code: Shared, mixer: Shared, inputs: int) -> tuple[np.ndarray, np.ndarray]:
    """The mixer's weights and the last stage; one row of fixed size per task is written and added up."""
    found = written(passed(stream, _learn_pass(code, mixer, inputs), _LEARNT), "learnt")
    weights = averaged(found.select(F.explode("learnt").alias("r")).select("r.*"), GATES * KINDS, inputs)
    came = np.zeros(GATES * KINDS * STEPS * 2)
    for r in found.select(F.posexplode("came").alias("k", "n")).groupBy("k").agg(F.sum("n").alias("n")).collect():
        came[r["k"]] = r["n"]
    return weights, refined(came.reshape(-1, 2))


# --- scores -----------------------------------------------------------------------------------------------------------

_SCORES = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()),
                        T.StructField("n_known", T.LongType()), T.StructField("train_tokens", T.LongType()), T.StructField("base_score", T.DoubleType()),
                        T.StructField("score", T.DoubleType()), T.StructField("bits_per_byte", T.DoubleType())])


def _score_pass(code: Shared, mixer: Shared, weights: np.ndarray, last: np.ndarray, tokens: int):
    def scored(row: dict) -> dict:
        stream = Stream(row, code.value)
        score = np.add.reduceat(log_probabilities(mixer.value, stream, weights, last), stream.starts) / math.log(10)
        return {"doc_id": row["ids"], "held_out": [held_out(i) for i in row["ids"]], "n_tokens": row["n_tokens"], "n_known": row["n_known"],
                "train_tokens": [tokens] * len(score), "base_score": row["base_score"], "score": score,
                "bits_per_byte": -score * math.log2(10) / np.maximum(1, np.array(row["sizes"]))}

    return lambda batches: map(scored, rows(batches))


def score_texts(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Null and empty texts are one end token.  A null doc_id counts as an empty string for the fold.  Repeated rows are
    scored each on its own, and each trains: a row's copies predict it, its own occurrences don't.  Words of any length are
    coded whole.  Other columns are ignored; an empty table gives no rows, and without training text every word is unknown.
    """
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    blocks = pack_blocks(docs.select("doc_id", "text"), BLOCK_BYTES)
    total = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    text = blocks.select("block", "ids", "sizes", "body")
    bits = max(4, (total // 40 // WORDS_PER_BUCKET).bit_length())
    lexicon = written(passed(text, _word_pass(bits), _WORDS).groupBy("key").applyInArrow(_merge, _LEXICON), "lexicon")
    sums = lexicon.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n"), F.coalesce(F.sum("distinct"), F.lit(0)).alias("v")).first()
    code = Shared(spark, vocabulary(lexicon, sums["n"]))
    words = lexicon.select("words", "counts")
    tables = Shared(spark, context_tables(passed(words, _spelling_pass(code), _TABLES), TABLE_BITS), Stretched)
    weights = averaged(passed(words, _spelling_train_pass(code, tables), _WEIGHTS), GATES, len(ORDERS))
    word_replies = passed(lexicon.select("key", "words", "counts", "blocks", "sizes", "places"), _answer_words(code, tables, weights), _WORD_REPLY)
    bits = max(3, (total // 7 // RUNS_PER_BUCKET).bit_length())
    run_replies = passed(text, _run_pass(bits, code), _RUNS).groupBy("key").applyInArrow(_answer_runs(code), _RUN_REPLY)
    answered = text.join(word_replies.groupBy("block").agg(F.collect_list(F.struct("key", "counts", "spelled")).alias("word_replies")), "block")
    answered = answered.join(run_replies.groupBy("block").agg(F.collect_list(F.struct("key", "body")).alias("run_replies")), "block")
    stream = written(passed(answered, _stream_pass(code, sums["n"], sums["v"]), _STREAM), "stream")
    sizes = tuple(min(b, max(12, (total // 64).bit_length())) for b in RUNNING_BITS)
    mixer = Shared(spark, context_tables(passed(stream, _table_pass(code, sizes), _TABLES), sizes), Mixer)
    weights, last = mixing(stream, code, mixer, len(sizes))
    return passed(stream, _score_pass(code, mixer, weights, last, sums["n"]), _SCORES)
