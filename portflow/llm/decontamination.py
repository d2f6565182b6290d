"""Benchmark decontamination by Wu-Manber search over words.

Test items become patterns of ``window`` consecutive words (one shorter pattern if the item has fewer words).
Patterns of equal length form one searcher: for each block of two words, a shift table says how far the search may
skip; a block that ends patterns has shift zero and leads to a bucket of test strings, chosen by their first block as
well, whose words are then compared one by one.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portflow.llm.common import LOWER, free_name, map_arrow, texts, written

WINDOW = 13
#: bytes of test texts that one broadcast may hold; more are searched block after block
BLOCK_BYTES = 8 << 20
#: keeps digits, letters (A-Z lower-cased) and every byte beyond ASCII; the rest become spaces
_TABLE = bytes(LOWER[c] if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words(text: bytes | None) -> list[bytes]:
    """Lower-cased words: digits, ASCII letters and everything beyond ASCII."""
    return text.translate(_TABLE).split() if text else []


class WuManber:
    """All patterns have ``m`` words."""

    def __init__(self, m: int, patterns: dict[tuple[bytes, ...], set[str]]):
        self.m, self.b = m, min(2, m)
        self.most = m - self.b + 1
        self.shift: dict[bytes, int] = {}
        self.bucket: dict[bytes, dict[bytes, list[tuple[list[bytes], set[str]]]]] = {}
        for p, items in patterns.items():
            for j in range(self.b, m + 1):
                block = b" ".join(p[j - self.b:j])
                self.shift[block] = min(self.shift.get(block, self.most), m - j)
            tests = self.bucket.setdefault(b" ".join(p[m - self.b:]), {})
            tests.setdefault(b" ".join(p[:self.b]), []).append((list(p), items))

    def search(self, text: list[bytes], hit: bytearray, found: set[str]) -> None:
        m, b, most, shift, i, n = self.m, self.b, self.most, self.shift.get, self.m - 1, len(text)
        while i < n:
            block = text[i - 1] + b" " + text[i] if b == 2 else text[i]
            skip = shift(block, most)
            if skip:
                i += skip
                continue
            first = i - m + 1
            for p, items in self.bucket[block].get(text[first] + b" " + text[first + 1] if b == 2 else text[first], ()):
                if text[first:i + 1] == p:
                    hit[first:i + 1] = b"\x01" * m
                    found |= items
            i += 1


def searchers(items: list[tuple[str, bytes | None]], window: int = WINDOW) -> list[WuManber]:
    by_length: dict[int, dict[tuple[bytes, ...], set[str]]] = defaultdict(lambda: defaultdict(set))
    for item, text in items:
        w = words(text)
        m = min(window, len(w))
        for j in range(len(w) - m + 1 if m else 0):
            by_length[m][tuple(w[j:j + m])].add(item)
    return [WuManber(m, p) for m, p in sorted(by_length.items())]


_STATE = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("hit", T.BinaryType()), T.StructField("items", T.ArrayType(T.StringType()))])


def _search_block(docs: DataFrame, state: str, tests, text_col: str = "text") -> DataFrame:
    """Add one block's hits and items to the struct column ``state`` (made anew where it is missing)."""
    old = state in docs.columns
    schema = docs.schema if old else T.StructType([*docs.schema.fields, T.StructField(state, _STATE)])

    def per_batch(batch: pa.RecordBatch) -> dict:
        found_in, so_far = tests.value, batch.column(state).to_pylist() if old else None
        rows = []
        for k, text in enumerate(texts(batch, text_col)):
            w = words(text)
            hit, items = bytearray(len(w)), set()
            if so_far and so_far[k]["hit"]:
                hit[:] = so_far[k]["hit"]
            if so_far:
                items |= set(so_far[k]["items"])
            for s in found_in:
                if len(w) >= s.m:
                    s.search(w, hit, items)
            rows.append({"n_words": len(w), "n_hit": sum(hit), "hit": bytes(hit) if any(hit) else b"", "items": sorted(items)})
        return {c: batch.column(c) for c in batch.schema.names if c != state} | {state: rows}

    return map_arrow(docs, per_batch, schema)


def search(docs: DataFrame, benchmark: DataFrame, state: str, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with a struct column ``state``: n_words, n_hit, hit (a byte per word, empty if none), items.

    The test set is read block by block; a block's texts have about ``block_bytes`` bytes however large the set is.
    """
    spark = docs.sparkSession
    tests = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("binary").alias("text"))
    total = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    of = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    for k in range(blocks):
        items = [(r["item"], bytes(r["text"]) if r["text"] is not None else None) for r in (tests.where(of == k) if blocks > 1 else tests).collect()]
        docs = _search_block(docs, state, spark.sparkContext.broadcast(searchers(items, window)))
        if blocks > 1:
            docs = written(docs, "decontamination")
    return docs


def contaminated(n_words: F.Column, n_hit: F.Column) -> F.Column:
    """A twentieth of the words or more lies in occurrences of windows."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Null and empty texts have no words and aren't contaminated.  Items without words match nothing; a null item_id
    counts as an empty string; repeated items count once.  Repeated documents are judged each on its own.  Other
    columns are ignored; an empty table of documents gives no rows, an empty benchmark no hits.
    """
    found = search(docs.select("doc_id", "text"), benchmark, "_s", window, block_bytes)
    return found.select("doc_id", "_s.n_words", "_s.n_hit",
                        F.size("_s.items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", F.array_sort("_s.items")), 256).alias("items_sha256")).select(
        "*", contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents that aren't contaminated, with their own columns."""
    s = free_name(docs, "_search")
    found = search(docs, benchmark, s, window, block_bytes)
    return found.where(~contaminated(F.col(f"{s}.n_words"), F.col(f"{s}.n_hit"))).select(*(F.col(f"`{c}`") for c in docs.columns))


def oracle(window: int = WINDOW) -> str:
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH d AS (SELECT doc_id, {words} AS ws FROM documents),
item AS (SELECT item_id, ws, least({window}, len(ws)) AS m FROM (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, {words} AS ws FROM benchmark) WHERE len(ws) > 0),
iw AS (SELECT DISTINCT item_id, m, array_to_string(ws[i:i + m - 1], ' ') AS k FROM (SELECT item_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM item)),
dw AS (SELECT doc_id, m, i, array_to_string(ws[i:i + m - 1], ' ') AS k
    FROM (SELECT doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM iw) WHERE len(ws) >= m)),
occ AS (SELECT doc_id, i, m, item_id FROM dw JOIN iw USING (m, k)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM occ) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS s FROM (SELECT DISTINCT doc_id, item_id FROM occ) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(found.n, 0) AS n_items, coalesce(s, sha256('')) AS items_sha256,
    coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)
"""
