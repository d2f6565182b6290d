"""Quality rules by tokeniser fertility.

Public vocabularies measure a text: characters per token of two vocabularies, the share of byte-fallback tokens, and
the entropy of its tokens.  A band per language or script says which values a clean text can have.
"""

from __future__ import annotations


import base64
from itertools import chain

import numpy as np
import public_tokenizers
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portflow.llm.common import CONTINUATION, WHITE, free_name, portions, with_measures

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
CACHE_WORDS = 300_000
SYMBOLS = b"#*$%&|<>"

#: (least, most) characters per token of the piece vocabulary and of the byte vocabulary, most byte-fallback tokens
#: per token, least entropy in bits (of texts with ENTROPY_TOKENS tokens or more); by language, else by script.  The
#: least characters per token are about the 0.1 % quantiles of 18,000 test documents that pass the base rule; random
#: letters have 1.5 to 1.7 in texts of 25 words or more.  "accented" is Latin script with other letters than a to z,
#: which the vocabularies know less of; no reference text of such a language stands behind it.
BANDS: dict[str, tuple[float, float, float, float, float, float]] = {
    "en": (1.85, 6.0, 1.85, 6.5, 0.05, 4.0),
    "de": (1.90, 6.0, 1.80, 6.5, 0.05, 4.0),
    "fr": (1.68, 6.0, 1.66, 6.5, 0.05, 4.0),
    "es": (1.73, 6.0, 1.60, 6.5, 0.05, 4.0),
    "latin": (1.72, 7.0, 1.60, 7.0, 0.20, 3.5),
    "accented": (1.2, 7.0, 1.2, 7.0, 0.20, 3.5),
    "other": (0.3, 8.0, 0.3, 8.0, 0.95, 3.0),
}
SCRIPTS = ("latin", "accented", "other")
#: from this share of ASCII characters on, Latin script isn't accented
ASCII_PERCENT = 95
ENTROPY_TOKENS = 64

MEASURES = T.StructType([
    *(T.StructField(c, T.LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
    *(T.StructField(c, T.LongType()) for c in ("n_tokens", "n_fallback", "n_merged", "n_ascii")),
    T.StructField("token_entropy", T.DoubleType()),
])

_DROP = CONTINUATION + WHITE
_NOT_ASCII = bytes(range(0x80, 0x100))
_MIX = np.array([pow(0x9E3779B97F4A7C15, 2 * j + 1, 1 << 64) for j in range(WINDOW)], np.uint64)


def repeated_words(codes: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that are found twice or more (the first time included)."""
    n = len(codes) - window + 1
    if n < 2:
        return 0
    key = np.zeros(n, np.uint64)
    for j in range(window):
        key += codes[j:j + n].astype(np.uint64) * _MIX[j]
    order = np.argsort(key, kind="stable")
    twin = np.nonzero(key[order[1:]] == key[order[:-1]])[0]
    if not len(twin):
        return 0
    views = np.lib.stride_tricks.sliding_window_view(codes, window)
    a, b = order[twin], order[twin + 1]
    equal = (views[a] == views[b]).all(1)  # equal keys are nearly always equal windows; others are told apart here
    if equal.all():
        hit = np.concatenate([a, b])
    else:
        same: dict[bytes, list[int]] = {}
        for i in set(a.tolist()) | set(b.tolist()):
            same.setdefault(views[i].tobytes(), []).append(i)
        hit = np.array([i for v in same.values() if len(v) > 1 for i in v], np.int64)
    step = np.zeros(len(codes) + 1, np.int64)
    starts = np.unique(hit)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + window, -1)
    return int((np.cumsum(step) > 0).sum())


class Fertility:
    """Measures of texts; what the vocabularies say of a word is kept for the next time."""

    def __init__(self, pieces: str, ranks: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.get_piece_size())], np.int64)
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.merge = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})._core_bpe.encode_single_piece
        self.clear()

    def clear(self) -> None:
        self.code: dict[bytes, int] = {}
        self.n_pieces = self.n_fallback = self.n_merged = self.at = np.empty(0, np.int64)
        self.flat = np.empty(0, np.uint16)

    def learn(self, new: list[bytes]) -> None:
        """Words are encoded as after a space: pieces with their word mark, merges with the space itself."""
        ids = self.model.encode([w.decode() for w in new], num_threads=1)
        size = np.fromiter(map(len, ids), np.int64, len(new))
        flat = np.fromiter(chain.from_iterable(ids), np.uint16, int(size.sum()))
        ends = np.cumsum(size)
        fallback = np.diff(np.r_[0, np.r_[0, np.cumsum(self.is_byte[flat])][ends]])
        self.code.update(zip(new, range(len(self.code), len(self.code) + len(new))))
        self.at = np.r_[self.at, len(self.flat) + ends - size]
        self.flat = np.r_[self.flat, flat]
        self.n_pieces, self.n_fallback = np.r_[self.n_pieces, size], np.r_[self.n_fallback, fallback]
        merge = self.merge
        self.n_merged = np.r_[self.n_merged, np.fromiter((len(merge(b" " + w)) for w in new), np.int64, len(new))]

    def entropy(self, codes: np.ndarray) -> float:
        """Of the pieces' distribution in the text, in bits."""
        size = self.n_pieces[codes]
        total = int(size.sum())
        if not total:
            return 0.0
        shift = np.repeat(self.at[codes] - np.cumsum(size) + size, size)
        ids = np.sort(self.flat[shift + np.arange(total)])
        runs = np.diff(np.r_[np.nonzero(np.r_[True, ids[1:] != ids[:-1]])[0], total])
        return max(0.0, float(np.log2(total) - (runs * np.log2(runs)).sum() / total))

    def measure(self, texts: list[bytes | None]) -> list[tuple]:
        if len(self.code) > CACHE_WORDS:
            self.clear()
        texts = [x or b"" for x in texts]
        words = [x.split() for x in texts]
        self.learn(list(set().union(*words).difference(self.code)))
        code, out = self.code, []
        for text, own in zip(texts, words):
            codes = np.array([code[w] for w in own], np.int64)
            lines = [x for x in text.split(b"\n") if x.strip()]
            out.append((len(own), len(text.translate(None, _DROP)), len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines)),
                        repeated_words(codes), int(self.n_pieces[codes].sum()), int(self.n_fallback[codes].sum()), int(self.n_merged[codes].sum()),
                        len(text.translate(None, _NOT_ASCII + WHITE)), self.entropy(codes)))
        return out


_LOADED: dict[tuple[str, str], Fertility] = {}


def fertility(docs: DataFrame, name: str, pieces: str | None = None, ranks: str | None = None) -> DataFrame:
    """``docs`` with a struct column ``name`` of MEASURES (null text: all zero)."""
    paths = pieces or public_tokenizers.path("piece_bpe_32k.model"), ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")

    def measure(batch: list[bytes | None]) -> list[tuple]:
        if paths not in _LOADED:
            _LOADED[paths] = Fertility(*paths)
        return [row for part in portions(batch) for row in _LOADED[paths].measure(part)]

    return with_measures(docs, MEASURES, measure, name)


def verdict(m: str, lang: F.Column | None, bands: dict[str, tuple] | None = None) -> dict[str, F.Column]:
    """base_failed, kept and the ratios, from the struct column ``m``; ``lang`` may be null or unknown."""
    bands = bands or BANDS
    of = lambda c: F.col(f"{m}.{c}")
    per_piece = F.try_divide(of("word_chars").cast("double"), of("n_tokens"))
    per_merged = F.try_divide(of("word_chars").cast("double"), of("n_merged"))
    share = F.try_divide(of("n_fallback").cast("double"), of("n_tokens"))
    accented = "accented" if "accented" in bands else "latin"
    script = F.when(100 * of("n_ascii") >= ASCII_PERCENT * of("word_chars"), "latin").when(2 * of("n_ascii") >= of("word_chars"), accented).otherwise("other")
    band = F.coalesce(F.when(lang.isin(*[k for k in bands if k not in SCRIPTS]), lang), script) if lang is not None else script
    inside = F.lit(False)
    for k, (low, high, low_merged, high_merged, most, least) in bands.items():
        inside = inside | ((band == k) & per_piece.between(low, high) & per_merged.between(low_merged, high_merged) & (share <= most)
                           & ((of("token_entropy") >= least) | (of("n_tokens") < ENTROPY_TOKENS)))
    base = (of("n_words") < MIN_WORDS) | (100 * of("n_repeat_words") > MAX_REPEAT_PERCENT * of("n_words"))
    return {"base_failed": base, "kept": ~base & F.coalesce(inside, F.lit(False)), "chars_per_token": per_piece,
            "chars_per_merged": per_merged, "fallback_share": share, "token_entropy": of("token_entropy"), "band": band}


def quality_rules(docs: DataFrame, bands: dict[str, tuple] | None = None) -> DataFrame:
    """One row per document: doc_id, the base counts, base_failed, kept, and the fertility measures.

    Null and empty texts have no words, so they fail the base rule.  Repeated rows are judged each on its own; a null
    or unknown ``lang`` (or no such column) is judged by the script's band.  Whole texts are measured.  Columns other
    than doc_id, text and lang are ignored; an empty table gives no rows.
    """
    measured = fertility(docs.select("doc_id", "text", *(["lang"] if "lang" in docs.columns else [])), "_m")
    v = verdict("_m", F.col("lang") if "lang" in docs.columns else None, bands)
    return measured.select("doc_id", *(F.col(f"_m.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
                           *(c.alias(k) for k, c in v.items()))


def keep_quality(docs: DataFrame, bands: dict[str, tuple] | None = None) -> DataFrame:
    """The documents that the rules keep, with their own columns."""
    m = free_name(docs, "_fertility")
    v = verdict(m, F.col("lang") if "lang" in docs.columns else None, bands)
    return fertility(docs, m).where(v["kept"]).select(*(F.col(f"`{c}`") for c in docs.columns))
