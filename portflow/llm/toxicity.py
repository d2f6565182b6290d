"""Toxicity by the nearest labelled examples under exact TF-IDF cosine, from a block-max inverted index.

Terms are words and their five-letter stems.  The vocabulary holds the terms of a bounded labelled sample whose presence
goes with the label (likelihood ratio); all other words of a text count together as one more term.  Document frequencies
come from all documents.  Labelled vectors that are equal become one example with the mean of their labels.  Examples lie
in blocks; a term's postings are cut at the blocks' borders, and each (term, block) keeps its largest weight.  A text's
blocks are visited in the order of their upper bounds until no bound can reach the k-th best cosine, so the neighbours
are exact.  They vote with weights that fall with distance; votes are calibrated by isotonic regression over votes of
the labelled examples, each without its own.  The nearest examples and the leading terms are given as evidence.
"""

from __future__ import annotations

import zlib
from collections import Counter
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portflow.llm.common import bounded_batches, map_arrow, portions, texts, written

FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
#: bound on the labelled training rows that teach; the ones with the least hashes of their ids
SAMPLE = 8000
#: bound on the vocabulary; terms need so many labelled texts
TERMS, MIN_TEXTS = 2048, 4
#: chance that any term at all gets in by luck alone (G-squared's bound follows from it and from the number of terms)
LUCK = 0.05
STEM = 5
NEIGHBOURS = 24
SHARPNESS = 24.0
BLOCK = 64
#: texts that are compared at once
QUERIES = 256
EVIDENCE = 3
CACHE_WORDS = 300_000

#: ASCII other than letters and digits parts words; A-Z are lower-cased
_SIGNS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_SIGNS).split()


def terms_of(word: bytes) -> tuple[str, ...]:
    """A word and, if it is longer, its stem."""
    word = word.decode("utf-8", "replace").lower()
    return (word, word[:STEM] + "*") if len(word) > STEM else (word, word + "*")


class Vocabulary:
    """Codes of terms; a word's codes are kept for the next time."""

    def __init__(self, terms: list[str]):
        self.terms, self.code = terms, {t: k for k, t in enumerate(terms)}
        self.known: dict[bytes, tuple[int, ...]] = {}

    def count(self, text: bytes | None) -> tuple[list[int], list[int], int]:
        """Codes in order, how often each occurs, and the words that have none."""
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        known, code, found, other = self.known, self.code, Counter(), 0
        for word, n in Counter(words_of(text)).items():
            hits = known.get(word)
            if hits is None:
                hits = known[word] = tuple(code[t] for t in terms_of(word) if t in code)
            if hits:
                for k in hits:
                    found[k] += n
            else:
                other += n
        at = sorted(found)
        return at, [found[k] for k in at], other


class Index:
    """Examples in blocks of ``block``: each block's postings (its terms by its examples) and each term's largest weight in it."""

    def __init__(self, idf: np.ndarray, rows: list[tuple[list[int], list[int], int]], y: np.ndarray, ids: np.ndarray, block: int = BLOCK):
        self.idf, self.block = idf, block
        merged: dict[tuple, list] = {}
        for row, label, i in zip(rows, y, ids):
            at, x = self.vector(*row)
            own = merged.setdefault(self.name(at, x), [at, x, 0.0, 0, int(i)])
            own[2], own[3], own[4] = own[2] + float(label), own[3] + 1, min(own[4], int(i))
        # neighbours in the index share their heaviest term, which makes the blocks' bounds tight
        examples = sorted(merged.values(), key=lambda e: (int(e[0][np.argmax(e[1])]) if len(e[0]) else -1, -float(e[1].max()) if len(e[0]) else 0.0, e[4]))
        self.where = {self.name(e[0], e[1]): k for k, e in enumerate(examples)}
        self.label = np.array([e[2] for e in examples], float)
        self.many = np.array([e[3] for e in examples], float)
        self.id = np.array([e[4] for e in examples], np.int64)
        self.postings, self.most = [], np.zeros((len(idf), -(-len(examples) // block)))
        for b in range(self.most.shape[1]):
            part = examples[b * block:(b + 1) * block]
            codes = np.unique(np.concatenate([e[0] for e in part]))
            weights = np.zeros((len(codes), len(part)))
            for k, e in enumerate(part):
                weights[np.searchsorted(codes, e[0]), k] = e[1]
            self.postings.append((codes, weights))
            self.most[codes, b] = weights.max(1) if len(part) else 0

    @staticmethod
    def name(at: np.ndarray, x: np.ndarray) -> tuple[bytes, bytes]:
        return at.tobytes(), np.round(x, 9).tobytes()

    def vector(self, at, count, other: int) -> tuple[np.ndarray, np.ndarray]:
        """Codes and weights of length one; the last code stands for all other words."""
        at = np.asarray(list(at) + [len(self.idf) - 1] * (other > 0), np.int64)
        x = (1 + np.log(np.asarray(list(count) + [other] * (other > 0), float))) * self.idf[at]
        return at, x / (np.linalg.norm(x) or 1.0)

    def nearest(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray]:
        """For each vector the ``k`` examples of the largest cosines, best first; equal ones: those first in the index.

        A vector visits the blocks by falling bounds and stops at the first bound below its k-th best cosine.
        """
        n, k = len(vectors), min(k, len(self.id))
        query = np.zeros((n, len(self.idf)))
        for q, (at, x) in enumerate(vectors):
            query[q, at] = x
        bound = query @ self.most
        order = np.argsort(-bound, axis=1, kind="stable")
        best, best_at = np.full((n, k), -1.0), np.full((n, k), len(self.id))
        alive = np.arange(n)
        for turn in range(self.most.shape[1]):
            alive = alive[bound[alive, order[alive, turn]] >= best[alive, -1] - 1e-9]
            if not len(alive):
                break
            for b in np.unique(order[alive, turn]):
                own = alive[order[alive, turn] == b]
                codes, weights = self.postings[b]
                cosine = np.round(query[np.ix_(own, codes)] @ weights, 10)
                at = np.broadcast_to(np.arange(b * self.block, b * self.block + cosine.shape[1]), cosine.shape)
                both, both_at = np.hstack([best[own], cosine]), np.hstack([best_at[own], at])
                first = np.argsort(both_at, axis=1, kind="stable")
                keep = np.take_along_axis(first, np.argsort(-np.take_along_axis(both, first, 1), axis=1, kind="stable")[:, :k], 1)
                best[own], best_at[own] = np.take_along_axis(both, keep, 1), np.take_along_axis(both_at, keep, 1)
        return best_at, best

    def vote(self, near: np.ndarray, cosine: np.ndarray, without: int | None = None, label: float = 0.0) -> float:
        """Share of the label among the neighbours, by similarity and by how many texts an example stands for."""
        many, labels = self.many[near], self.label[near]
        if without is not None:
            own = near == without
            many, labels = many - own, labels - own * label
        weight = np.exp(SHARPNESS * (np.minimum(cosine, 1.0) - 1))
        total = float((weight * many).sum())
        return min(1.0, max(0.0, float((weight * labels).sum() / total))) if total > 0 else 0.5


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the least-squares rising step function, its steps' means at their middles."""
    blocks: list[list[float]] = []
    order = np.lexsort((y, x))
    xs, which = np.unique(x[order], return_inverse=True)
    sums, counts = np.bincount(which, y[order]), np.bincount(which)
    for value, s, n in zip(xs, sums, counts):
        blocks.append([s, n, value * n])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, n, v = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + n, blocks[-1][2] + v]
    return np.array([b[2] / b[1] for b in blocks]), np.array([b[0] / b[1] for b in blocks])


class Model:
    """The index and the calibration."""

    def __init__(self, idf: np.ndarray, rows: list[tuple[list[int], list[int], int]], y: np.ndarray, ids: np.ndarray, neighbours: int = NEIGHBOURS):
        self.index, self.neighbours = Index(idf, rows, y, ids), neighbours
        self.kept: dict[bool, tuple] = {}
        votes = [self.index.vote(near, cosine, self.index.where[self.index.name(*vector)], float(label))
                 for (vector, near, cosine), label in zip(self._near(rows, neighbours + 1), y)]
        self.votes, self.chances = isotonic(np.array(votes), np.asarray(y, float)) if len(rows) else (np.array([0.5]), np.array([0.5]))

    def _near(self, rows: list[tuple], k: int):
        for s in range(0, len(rows), QUERIES):
            vectors = [self.index.vector(*r) for r in rows[s:s + QUERIES]]
            yield from zip(vectors, *self.index.nearest(vectors, k))

    def score(self, rows: list[tuple]) -> list[tuple[float, list[tuple[int, float, float, int]], list[int]]]:
        """Calibrated chance, (doc_id, cosine, label, texts) of the nearest examples, and codes of the leading terms."""
        if not len(self.index.id):
            return [(0.5, [], [])] * len(rows)
        out: list = [self.kept.get(r[2] > 0) if not r[0] else None for r in rows]  # texts without a term are all alike
        todo = [k for k, x in enumerate(out) if x is None]
        for k, ((at, x), near, cosine) in zip(todo, self._near([rows[k] for k in todo], self.neighbours)):
            chance = float(np.interp(self.index.vote(near, cosine), self.votes, self.chances))
            shown = [(int(self.index.id[e]), float(c), float(self.index.label[e] / self.index.many[e]), int(self.index.many[e])) for e, c in zip(near[:EVIDENCE], cosine)]
            leading = [int(t) for t in at[np.argsort(-x, kind="stable")] if t < len(self.index.idf) - 1][:EVIDENCE]
            out[k] = min(1.0, max(0.0, chance)), shown, leading
            if not rows[k][0]:
                self.kept[rows[k][2] > 0] = out[k]
        return out


# on Spark --------------------------------------------------------------------------------------------------------------

def fold(doc_id: F.Column) -> F.Column:
    """crc32 of the id's digits (a null id: of an empty string) by FOLDS."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def labelled(labels: DataFrame, label: str, sample: int) -> DataFrame:
    """doc_id, y of at most ``sample`` labelled training ids: those with the least hashes."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(f"`{label}`").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT))
    return known.groupBy("doc_id").agg(F.avg(F.col(f"`{label}`").cast("double")).alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)


def vocabulary(docs: DataFrame, known: DataFrame, most: int = TERMS) -> list[str]:
    """Terms that go with the label in the labelled texts, at most ``most``, best first."""
    schema = T.StructType([T.StructField("term", T.StringType()), T.StructField("n", T.LongType()), T.StructField("pos", T.DoubleType())])

    def per_batch(batch: pa.RecordBatch) -> dict:
        n, pos = Counter(), Counter()
        for text, y in zip(texts(batch, "text"), batch.column("y").to_pylist()):
            own = {t for w in set(words_of(text)) for t in terms_of(w)}
            n.update(own)
            if y:
                for t in own:
                    pos[t] += y
        return {"term": list(n), "n": list(n.values()), "pos": [float(pos[t]) for t in n]}

    # copies of one text count once
    texts_known = written(docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").groupBy("text").agg(F.avg("y").alias("y")), "labelled_texts")
    counts = written(map_arrow(texts_known, per_batch, schema).groupBy("term").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")).where(F.col("n") >= MIN_TEXTS), "terms")
    least = NormalDist().inv_cdf(1 - LUCK / 2 / max(1, counts.count())) ** 2
    size = texts_known.agg(F.count("*").alias("n"), F.coalesce(F.sum("y"), F.lit(0.0)).alias("pos")).first()

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    share = size["pos"] / max(1, size["n"])
    if not 0 < share < 1:
        return []
    n, pos = F.col("n").cast("double"), F.col("pos")
    rest_n, rest_pos = size["n"] - n, size["pos"] - pos
    g2 = 2 * (part(pos, n * share) + part(n - pos, n * (1 - share)) + part(rest_pos, rest_n * share) + part(rest_n - rest_pos, rest_n * (1 - share)))
    return [r["term"] for r in counts.select("term", g2.alias("g2")).where(F.col("g2") >= least).orderBy(F.desc("g2"), "term").limit(most).collect()]


def counted(docs: DataFrame, terms: list[str]) -> DataFrame:
    """doc_id, at, n, other of every document, written once."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(terms))
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("at", ints), T.StructField("n", ints), T.StructField("other", T.LongType())])

    def per_batch(batch: pa.RecordBatch) -> dict:
        rows = [shared.value.count(x) for part in portions(texts(batch, "text")) for x in part]
        at, n, other = zip(*rows)
        return {"doc_id": batch.column("doc_id"), "at": at, "n": n, "other": other}

    return written(map_arrow(docs.select("doc_id", "text"), per_batch, schema), "counts")


def frequencies(vectors: DataFrame, n_terms: int) -> np.ndarray:
    """In how many documents each term occurs (the last: any other word), summed up batch by batch before the shuffle."""
    schema = T.StructType([T.StructField("term", T.IntegerType()), T.StructField("n", T.LongType())])

    def per_batch(batch: pa.RecordBatch) -> dict:
        n = np.bincount(batch.column("at").flatten().to_numpy(zero_copy_only=False).astype(np.int64), minlength=n_terms + 1)
        n[n_terms] = np.count_nonzero(batch.column("other").to_numpy(zero_copy_only=False) > 0)
        seen = np.nonzero(n)[0]
        return {"term": seen.astype(np.int32), "n": n[seen]}

    out = np.zeros(n_terms + 1)
    for r in map_arrow(vectors.select("at", "other"), per_batch, schema).groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r["term"]] = r["n"]
    return out


def fit(vectors: DataFrame, known: DataFrame, n_terms: int, neighbours: int = NEIGHBOURS) -> Model:
    """Document frequencies of all documents; the labelled rows (bounded) come to the driver."""
    n_docs = vectors.count()
    idf = np.log((n_docs + 1) / (frequencies(vectors, n_terms) + 1)) + 1
    sample = vectors.join(F.broadcast(known), "doc_id").groupBy("doc_id").agg(F.min(F.struct("at", "n", "other")).alias("v"), F.first("y").alias("y")).collect()
    sample.sort(key=lambda r: r["doc_id"])
    ids = np.array([r["doc_id"] if isinstance(r["doc_id"], int) else zlib.crc32(str(r["doc_id"]).encode()) for r in sample], np.int64)
    return Model(idf, [(r["v"]["at"], r["v"]["n"], r["v"]["other"]) for r in sample], np.array([r["y"] for r in sample]), ids, neighbours)


def score_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE, neighbours: int = NEIGHBOURS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, neighbours (doc_id, cosine, label, texts), terms.

    Only texts are compared; labels teach the training fold alone (several labels of one doc_id count as their mean,
    null labels and null ids not at all; of several texts of one doc_id one teaches).  A null or empty text is the zero
    vector, whose neighbours are the first examples of the index.  Equal cosines go to the example first in the index.
    Without labelled training rows every score is one half.  Repeated rows are scored each on its own; a text of any
    length is counted whole.  Other columns are ignored; an empty table gives no rows.
    """
    known = written(labelled(labels, label, sample), "labelled")
    terms = vocabulary(docs, known)
    vectors = counted(docs, terms)
    shared = docs.sparkSession.sparkContext.broadcast(fit(vectors, known, len(terms), neighbours))
    shown = T.ArrayType(T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("cosine", T.DoubleType()), T.StructField("label", T.DoubleType()), T.StructField("texts", T.LongType())]))
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("score", T.DoubleType()), T.StructField("neighbours", shown), T.StructField("terms", T.ArrayType(T.StringType()))])

    def per_batch(batch: pa.RecordBatch) -> dict:
        chances, near, leading = zip(*shared.value.score(list(zip(*(batch.column(c).to_pylist() for c in ("at", "n", "other"))))))
        return {"doc_id": batch.column("doc_id"), "score": chances, "terms": [[terms[t] for t in x] for x in leading],
                "neighbours": [[dict(zip(("doc_id", "cosine", "label", "texts"), e)) for e in x] for x in near]}

    bounded_batches(docs.sparkSession)
    scored = map_arrow(vectors, per_batch, schema)
    return scored.select("doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "neighbours", "terms")
