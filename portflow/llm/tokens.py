"""Token ids of the word-end BPE vocabulary, exactly as the ``tokenizers`` library gives them.

Texts are mostly repetitions of words, so ids are kept per white-space-separated chunk.  No pre-token of this
vocabulary spans white space, and none spans the border between a letter run and ASCII punctuation (the
contractions start with an apostrophe, which is kept with what follows).  Plain pieces of a new chunk (letters of
Latin-1, single digits, punctuation) go to a byte-pair merge with the same ranks; anything else, and any text with a
special token's string, goes to the library itself.  ``tests/llm`` compares ids with the library's on whole tables.
"""

from __future__ import annotations

import json
import re
import sys
from array import array

import tiktoken
from tokenizers import Tokenizer

from portflow.llm.common import LOWER

#: stands for the vocabulary's end-of-word mark; this byte is in no UTF-8 text
END = b"\xff"
CACHE_WORDS = 300_000
#: pieces of lower-cased chunks: letters of ASCII and Latin-1, single digits, punctuation other than the apostrophe
_PIECE = re.compile(r"[a-zß-öø-ÿÀ-ÖØ-Þ]+|[0-9]|[!-&(-/:-@\[-`{-~]+")
_PLAIN = re.compile(r"[a-zß-öø-ÿÀ-ÖØ-Þ0-9!-&(-/:-@\[-`{-~]+")


def _byte_of() -> dict[str, int]:
    """The usual printable stand-ins of byte-level vocabularies, by rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class WordBpe:
    """ids of whole texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            vocab: dict[str, int] = json.load(f)["model"]["vocab"]
        specials = {t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.special}
        self.specials = [s.encode() for s in specials]
        of, ranks = _byte_of(), {}
        for token, i in vocab.items():
            if token in specials:
                continue
            ends = token.endswith("</w>") and token != "</w>"
            raw = bytes(of[c] for c in (token[:-4] if ends else token))
            if END[0] not in raw:
                ranks[raw + END * ends] = i
        top = max(vocab.values()) + 1
        for b in range(256):  # the merge needs every byte; those that are missing occur in no UTF-8 text
            ranks.setdefault(bytes([b]), top + b)
        self.merge = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.kept: dict[bytes, bytes] = {}

    def library(self, text: str) -> bytes:
        return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def chunk(self, chunk: bytes) -> bytes:
        """ids of a chunk without ASCII white space and A-Z."""
        if chunk.isalpha():  # of bytes: ASCII letters only
            return packed(self.merge(chunk + END))
        text = chunk.decode()
        if not _PLAIN.fullmatch(text):
            return self.library(text)
        pieces, kept = [p.lower().encode() for p in _PIECE.findall(text)], self.kept
        if len(pieces) == 1:
            return packed(self.merge(pieces[0] + END))
        for p in pieces:
            if p not in kept:
                kept[p] = packed(self.merge(p + END))
        return b"".join([kept[p] for p in pieces])

    def ids(self, text: bytes) -> bytes:
        if b"<|" in text and any(s in text for s in self.specials):
            return self.library(text.decode())
        words, kept = text.translate(LOWER).split(), self.kept
        parts = list(map(kept.get, words))
        if None in parts:
            if len(kept) > CACHE_WORDS:
                kept.clear()
                parts = [None] * len(words)
            for w in {w for w, p in zip(words, parts) if p is None}:
                kept[w] = self.chunk(w)
            parts = [kept[w] for w in words]
        return b"".join(parts)


_LOADED: dict[str, WordBpe] = {}


def word_bpe(path: str) -> WordBpe:
    """One per worker process and path."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]
