"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

A text is a bag of terms: the shapes of its words (letter, capital, digit and symbol runs), its short words and word
ends, and steps of a few ratios that describe its form (repetition, line and word lengths, symbols).  Weighted and
normalised counts of a bounded sample of labelled training texts are factored once; the leading right vectors turn
any text into a latent vector.  The labelled vectors are broadcast; every document is compared with all of them by
blocked exact cosine products, and its nearest neighbours vote with weights that grow with similarity.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portflow.llm.common import map_arrow, portions, texts

FOLDS, HELD_OUT = 5, 0
#: bound on the labelled training rows that are fitted and broadcast
SAMPLE = 4000
TERMS = 4096
RANK = 48
NEIGHBOURS = 24
SHARPNESS = 24.0
THRESHOLD = 0.3
BLOCK = 512
CACHE_WORDS = 300_000

_SHAPE = bytes(97 if 97 <= c <= 122 or c >= 128 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c for c in range(256))
_LETTERS = bytes(c for c in range(256) if chr(c).isalnum() or c >= 128)


def _shape(word: bytes) -> bytes:
    """Runs of one class become one or two signs."""
    out, last, n = bytearray(), -1, 0
    for c in word.translate(_SHAPE)[:24]:
        n = n + 1 if c == last else 1
        if n <= 2:
            out.append(c)
        last = c
    return bytes(out)


def _slot(kind: bytes, term: bytes) -> int:
    return zlib.crc32(kind + term) % (TERMS - 512) + 512


class Terms:
    """Counts of terms; a word's terms are kept for the next time."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.code: dict[bytes, int] = {}
        self.slots = np.empty((0, 3), np.int64)

    def learn(self, new: list[bytes]) -> None:
        self.code.update(zip(new, range(len(self.code), len(self.code) + len(new))))
        rows = [(_slot(b"s", _shape(w)), _slot(b"e", w[-2:]), _slot(b"w", w.lower() if len(w) <= 4 else b"")) for w in new]
        self.slots = np.concatenate([self.slots, np.array(rows, np.int64).reshape(-1, 3)])

    def form(self, text: bytes, words: list[bytes], codes: np.ndarray) -> list[int]:
        """Steps of ratios: slots below 512, sixteen for each ratio."""
        n = max(1, len(words))
        distinct = len(np.unique(codes))
        lines = [x for x in text.split(b"\n") if x.strip()]
        symbols = len(text) - len(text.translate(None, b"#*$%&|<>{}[]=_~^\\@"))
        pairs = codes[1:] * (len(self.code) + 1) + codes[:-1]
        most = int(np.bincount(np.unique(codes, return_inverse=True)[1]).max()) if len(codes) else 0
        stops = text.count(b". ") + text.count(b".\n") + text.endswith(b".")
        ratios = (math.log2(n) / 16, distinct / n, len(np.unique(pairs)) / n, most / n, (len(lines) - len(set(lines))) / max(1, len(lines)), symbols / max(1, len(text)) * 4,
                  len(text) / n / 16, math.log2(1 + n / max(1, len(lines))) / 10, sum(map(text.count, (b"0", b"1", b"2", b"5", b"9"))) / max(1, len(text)) * 8,
                  math.log2(1 + n / max(1, stops)) / 10, len(text.translate(None, _LETTERS)) / max(1, len(text)) * 2)
        return [16 * k + min(15, int(16 * min(1.0, max(0.0, r)))) for k, r in enumerate(ratios)]

    def counts(self, batch: list[bytes | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        if len(self.code) > CACHE_WORDS:
            self.clear()
        batch = [x or b"" for x in batch]
        words = [x.split() for x in batch]
        self.learn(list(set().union(*words).difference(self.code)))
        code, out = self.code, []
        for text, own in zip(batch, words):
            codes = np.array([code[w] for w in own], np.int64)
            count = np.bincount(self.slots[codes].ravel(), minlength=TERMS).astype(np.float32)
            count /= max(1.0, 3.0 * len(own)) / 100
            count = np.log1p(count)
            count[self.form(text, own, codes)] = FORM_WEIGHT
            at = np.nonzero(count)[0]
            out.append((at, count[at]))
        return out


FORM_WEIGHT = 4.0
_TERMS = Terms()


def dense(rows: list[tuple[np.ndarray, np.ndarray]], idf: np.ndarray) -> np.ndarray:
    out = np.zeros((len(rows), TERMS), np.float32)
    for k, (at, x) in enumerate(rows):
        out[k, at] = x * idf[at]
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def right_vectors(x: np.ndarray, rank: int, rounds: int = 12) -> np.ndarray:
    """The leading right singular vectors by subspace iteration: memory for the rows and a thin basis only."""
    basis = np.linalg.qr(np.random.default_rng(0).standard_normal((x.shape[1], rank + 8)).astype(np.float32))[0]
    for _ in range(rounds if len(x) else 0):
        basis = np.linalg.qr(x.T @ (x @ basis))[0]
    _, _, turn = np.linalg.svd(x @ basis, full_matrices=False) if len(x) > rank + 8 else (0, 0, np.eye(rank + 8, dtype=np.float32))
    return np.ascontiguousarray((basis @ turn.T)[:, :rank]).astype(np.float32)


class Model:
    """Weights of terms, the projection, and the labelled vectors."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rank: int = RANK):
        n = max(1, len(rows))
        df = np.zeros(TERMS)
        for at, _ in rows:
            df[at] += 1
        self.idf = np.log((n + 1) / (df + 1)).astype(np.float32) + 1
        x = dense(rows, self.idf)
        self.project = right_vectors(x, rank)
        self.vectors = unit(x @ self.project)
        self.labels = labels.astype(np.float32)

    def score(self, rows: list[tuple[np.ndarray, np.ndarray]], neighbours: int = NEIGHBOURS) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(rows), 0.5)
        k, out = min(neighbours, len(self.labels)), []
        for s in range(0, len(rows), BLOCK):
            cosine = unit(dense(rows[s:s + BLOCK], self.idf) @ self.project) @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            vote = np.exp(SHARPNESS * (np.take_along_axis(cosine, near, 1) - 1)).astype(np.float64)
            out.append((vote * self.labels[near]).sum(1) / vote.sum(1))
        return np.clip(np.concatenate(out), 0, 1) if out else np.empty(0)


def fold(doc_id: F.Column) -> F.Column:
    """crc32 of the id's digits (a null id: of an empty string) by FOLDS."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def training_rows(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """at, x, y of a bounded sample of labelled training documents: those whose ids have the least hashes."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(f"`{label}`").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT))
    known = known.groupBy("doc_id").agg(F.avg(F.col(f"`{label}`").cast("double")).alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    picked = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y"))
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("at", T.BinaryType()),
                           T.StructField("x", T.BinaryType()), T.StructField("y", T.DoubleType())])

    def per_batch(batch: pa.RecordBatch) -> dict:
        rows = [r for part in portions(texts(batch, "text")) for r in _TERMS.counts(part)]
        return {"doc_id": batch.column("doc_id"), "at": [a.astype(np.int16).tobytes() for a, _ in rows], "x": [x.tobytes() for _, x in rows], "y": batch.column("y")}

    return map_arrow(picked, per_batch, schema)


def score_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, neighbours: int = NEIGHBOURS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Only texts are compared; labels teach the training fold alone (several labels of one doc_id count as their mean,
    null labels and null ids not at all).  Null and empty texts are vectors like any other; without labelled training
    rows every score is one half.  Repeated rows are scored each on its own.  Other columns are ignored; an empty
    table gives no rows.
    """
    spark = docs.sparkSession
    rows = sorted(training_rows(docs, labels, label, sample).collect(), key=lambda r: r["doc_id"])
    model = spark.sparkContext.broadcast(Model([(np.frombuffer(r["at"], np.int16).astype(np.int64), np.frombuffer(r["x"], np.float32)) for r in rows], np.array([r["y"] for r in rows])))
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("score", T.DoubleType())])

    def per_batch(batch: pa.RecordBatch) -> dict:
        score = [model.value.score(_TERMS.counts(part), neighbours) for part in portions(texts(batch, "text"))]
        return {"doc_id": batch.column("doc_id"), "score": np.concatenate(score)}

    scored = map_arrow(docs.select("doc_id", "text"), per_batch, schema)
    return scored.select("doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
