"""Main text of web pages by maximum-scoring subsequence.

A page is a run of tokens, words and tags.  A word scores one; a tag scores below zero, each kind by a weight learnt
from labelled pages: pages whose markup names the article.  A linear scan finds the contiguous region with the largest
sum.  Its words are given back block by block.  Elements that seldom hold an article's text, by their name, class or
id, are scored too, and left out unless they hold the named article or the highest-scoring text.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portflow.llm.common import map_arrow

#: bounds on the labelled pages that are learnt from, and on their size
SAMPLE = 400
SAMPLE_CHARS = 100_000
ROUNDS = 6
#: a tag's weight is never above this
LEAST_COST = -0.02
#: where no labelled page has the tag
UNKNOWN_COST = -1.0
#: of a marked element's score, where no labelled page has the mark
UNKNOWN_TRUST = 0.25
WORD = 1.0

#: elements whose content isn't text
RAW = ("script", "style", "noscript", "template", "svg", "iframe", "textarea", "title", "head")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|$)", re.I | re.A) for name in RAW}
#: elements that seldom hold the article's text
ASIDE = frozenset(("nav", "footer", "aside", "form", "button", "select", "menu", "dialog", "header"))
#: elements that are part of a line
INLINE = frozenset(("a", "abbr", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label",
                    "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))
#: class or id words that mark an element as seldom holding the article's text
MARKS = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|banner|comments?|cookies?|disqus|menu|modal|nav\w*|newsletter|notices?|popup|promo\w*|related|share|sharing|sidebar|social|sponsor\w*|subscribe|toolbar|widget)(?:$|[\s_-])", re.I)

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|$)|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(r"\b(?:class|id)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_SPACE = re.compile(r"\s+")

Run = list[tuple[str, str, int]]
#: a marked element: where its tag and its end stand in the run, the one around it (-1: none), and what marks it
Mark = tuple[int, int, int, str]


def _mark(name: str, rest: str, inside: int) -> str:
    """What marks the element as none of the article's text: its name, or the class or id that a word of MARKS is part of."""
    if name in VOID or rest.endswith("/"):
        return ""
    if name in ASIDE and not (name == "header" and inside):
        return name
    if name in ("html", "body", "article", "main") or not rest:
        return ""
    for a in _ATTRIBUTE.finditer(rest):
        for word in (a[1] or a[2] or a[3] or "").split():
            if MARKS.search(word):
                return "." + word.lower()
    return ""


def tokens(page: str) -> tuple[Run, list[Mark]]:
    """(kind, value, words): a text piece ("t"), its words counted, or a tag ("<", its name, with / where it ends).

    Comments and raw elements leave one tag each.  Marked and aside elements are tokens like others, their tags end in
    an exclamation mark; they are listed by their starts.
    """
    out: Run = []
    marks: list[list] = []
    opened: list[int] = []  # marked elements, innermost last
    depth: dict[int, int] = {}
    by_name: dict[str, list[int]] = {}
    around: dict[str, list[int]] = {"article": [], "main": []}
    at, n, inside = 0, len(page), 0

    def close(height: int) -> None:
        for k in reversed(opened[height:]):
            marks[k][1] = len(out)
            by_name[out[marks[k][0]][1]].pop()
        del opened[height:]

    while at < n:
        m = _TOKEN.match(page, at)
        at = m.end()
        end, name, rest = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            if m[0][0] != "<" or m[0] == "<":
                out.append(("t", m[0], len(m[0].split())))
            continue
        name = name.lower()
        if name in around:
            inside = max(0, inside + (-1 if end else 1))
            if not end:
                around[name].append(len(opened))
            elif around[name]:  # what is still open inside ends here
                close(around[name].pop())
        elif name == "body" and end:
            close(0)
        if not end and name in RAW and name != "head":
            stop = _RAW_END[name].search(page, at)
            at = stop.start() if stop else n
            out.append(("<", f"{name}!", 0))
            continue
        if not end and (key := _mark(name, rest, inside)):
            marks.append([len(out), -1, opened[-1] if opened else -1, key])
            opened.append(len(marks) - 1)
            depth[opened[-1]] = 1
            by_name.setdefault(f"{name}!", []).append(opened[-1])
            out.append(("<", f"{name}!", 0))
            continue
        same = by_name.get(f"{name}!")
        if same and not rest.endswith("/"):
            depth[same[-1]] += -1 if end else 1
            if not depth[same[-1]]:
                close(opened.index(same[-1]) if opened[-1] != same[-1] else len(opened) - 1)
                out.append(("<", f"/{name}!", 0))
                continue
        out.append(("<", f"/{name}" if end else name, 0))
    close(0)
    return out, [tuple(x) for x in marks]


def _around(marks: list[Mark], k: int) -> set[int]:
    """The marked element itself and those around it."""
    out = set()
    while k >= 0:
        out.add(k)
        k = marks[k][2]
    return out


def reduced(run: Run, marks: list[Mark], keep: set[int], within: int = -1) -> Run:
    """The run, or one marked element's content, without the marked elements that aren't kept: their two tags stay."""
    at, stop = (marks[within][0] + 1, marks[within][1]) if within >= 0 else (0, len(run))
    out: Run = []
    if keep:
        run = list(run)
        for k in keep:
            for i in marks[k][:2]:
                if i < len(run) and run[i][0] == "<":
                    run[i] = ("<", run[i][1].removesuffix("!"), 0)
    for k in range(within + 1, len(marks)):
        s, e, *_ = marks[k]
        if s >= stop:
            break
        if s >= at and k not in keep:
            out += run[at:s + 1]
            at = e
    return out + run[at:stop]


def article(run: Run, marks: list[Mark]) -> tuple[int, int, set[int]] | None:
    """What the markup itself names as the article, from its tag to its end, and the marked elements around it.

    It is the only one outside of the marked elements, or else the only one of the page.
    """
    hidden, at = [], 0
    for s, e, *_ in marks:
        if s >= at:
            hidden.append((s, e))
            at = e
    outside = [k for a, b in zip([0, *(e for _, e in hidden)], [*(s for s, _ in hidden), len(run)]) for k in range(a, b)]
    for places in (outside, range(len(run)) if hidden else ()):
        starts = [k for k in places if run[k][:2] == ("<", "article")]
        ends = [k for k in places if run[k][:2] == ("<", "/article")]
        if starts:
            if len(starts) != len(ends) or len(starts) != 1 or starts[0] > ends[0]:
                return None
            return starts[0], ends[0], {k for k, (s, e, *_) in enumerate(marks) if s < starts[0] < e}
    return None


def without_asides(run: Run, marks: list[Mark], weights: dict[str, float]) -> Run:
    """The run without the marked elements that hold neither the named article nor the highest-scoring text.

    Every marked element's own text is scored.  The best of its regions counts by how much its marks, and those around
    it, are to be trusted: a learnt share, as most of them are rightly marked.
    """
    if not marks:
        return run
    named = article(run, marks)
    keep = named[2] if named else set()
    out = reduced(run, marks, keep)
    most, best = max(best_sum(score(out, weights)), WORD), -1
    before = [0, *accumulate(t[2] for t in run)]
    words = [before[e] - before[s] for s, e, *_ in marks]
    for s, e, outer, _ in marks:
        if outer >= 0:
            words[outer] -= before[e] - before[s]
    trust: list[float] = []
    for k, (_, _, outer, key) in enumerate(marks):
        trust.append((trust[outer] if outer >= 0 else 1.0) * (1.0 if k in keep else weights.get(f"!{key}", UNKNOWN_TRUST)))
        if k not in keep and trust[k] * WORD * words[k] > most:
            total = trust[k] * best_sum(score(reduced(run, marks, set(), k), weights))
            if total > most:
                most, best = total, k
    return reduced(run, marks, keep | _around(marks, best)) if best >= 0 else out


def best_region(scores: list[float]) -> tuple[int, int]:
    """The contiguous range with the largest positive sum, the first and shortest of equal ones; (0, 0) if none."""
    best, at, total, start = 0.0, (0, 0), 0.0, 0
    for k, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, k
        total += s
        if total > best:
            best, at = total, (start, k + 1)
    return at


def best_sum(scores: list[float]) -> float:
    return sum(scores[slice(*best_region(scores))])


def score(run: Run, weights: dict[str, float]) -> list[float]:
    return [WORD * words if kind == "t" else weights.get(value, UNKNOWN_COST) for kind, value, words in run]


def learn(pages: list[str], rounds: int = ROUNDS) -> dict[str, float]:
    """Tag weights: log odds of lying inside the article at first, then moved until the regions found are the labelled ones.

    With an exclamation mark before: how much of a marked element's score counts, by what marks it.
    """
    runs, right, holds = [], Counter(), Counter()
    for run, marks in map(tokens, pages):
        if named := article(run, marks):
            s, e, keep = named
            holds.update({marks[k][3] for k in keep})
            right.update({m[3] for m in marks} - {marks[k][3] for k in keep})
            run = reduced(run, marks, keep) if marks else run
            at = run.index(("<", "article", 0))
            runs.append((run, (at + 1, run.index(("<", "/article", 0), at))))
    inside, outside = Counter(), Counter()
    for run, (s, e) in runs:
        for k, (kind, value, _) in enumerate(run):
            if kind == "<":
                (inside if s <= k < e else outside)[value] += 1
    weights = {v: min(LEAST_COST, math.log((inside[v] + 0.5) / (outside[v] + 0.5))) for v in {*inside, *outside}}
    for _ in range(rounds):
        wrong = 0
        for run, (s, e) in runs:
            words = lambda a, b: [k for k in range(a, b) if run[k][2]]
            gold, found = words(s, e), words(*best_region(score(run, weights)))
            if gold == found or not gold:
                continue
            wrong += 1
            a, b = (found[0], found[-1]) if found else (gold[0], gold[0])
            for k in range(len(run)):
                kind, value, _ = run[k]
                if kind == "<":
                    is_gold, is_found = gold[0] <= k <= gold[-1], a <= k <= b
                    if is_found and not is_gold:
                        weights[value] -= 4.0
                    elif is_gold and not is_found:
                        weights[value] = min(LEAST_COST, weights[value] * 0.5)
        if not wrong:
            break
    return weights | {f"!{key}": (holds[key] + 4 * UNKNOWN_TRUST) / (holds[key] + right[key] + 4) for key in {*right, *holds}}


def blocks(run: Run, region: tuple[int, int]) -> list[str]:
    out, line = [], []

    def close() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(line))).strip()
        if text:
            out.append(text)
        line.clear()

    for kind, value, _ in run[slice(*region)]:
        if kind == "t":
            line.append(value)
        elif value.strip("/!") == "br":
            line.append(" ")
        elif value.strip("/!") not in INLINE:
            close()
    close()
    return out


def extract(page: str | None, weights: dict[str, float]) -> str:
    if not page:
        return ""
    run = without_asides(*tokens(page), weights)
    return "\n\n".join(blocks(run, best_region(score(run, weights))))


def learn_weights(pages: DataFrame, sample: int = SAMPLE) -> dict[str, float]:
    """From a bounded sample of labelled pages: the distinct ones whose texts have the least hashes.

    The hashes are chosen first, so only the sample's pages leave their tasks.
    """
    key = F.xxhash64("html")
    labelled = pages.where(F.contains(F.lower("html"), F.lit("<article")) & (F.length("html") <= SAMPLE_CHARS)).select("html", key.alias("key"))
    most = labelled.groupBy("key").agg(F.lit(1)).orderBy("key").limit(sample).agg(F.max("key")).first()[0]
    if most is None:
        return learn([])
    chosen = labelled.where(F.col("key") <= most).groupBy("key").agg(F.min("html").alias("html")).collect()
    return learn([r["html"] for r in sorted(chosen, key=lambda r: r["key"])])


def extract_main_text(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Character references are decoded, white space in a block becomes one space, blocks are joined by two line feeds.
    Null and empty pages, and pages without words, have an empty text.  Unclosed comments, tags and elements reach to
    the end of the page.  Where no page is labelled, every tag costs the same.  Repeated rows are extracted each on
    its own; other columns are ignored; an empty table gives no rows.
    """
    learnt = pages.sparkSession.sparkContext.broadcast(learn_weights(pages) if weights is None else weights)
    keep = pages.select("page_id", "url", "html")
    schema = T.StructType([*keep.schema.fields[:2], T.StructField("text", T.StringType())])

    def per_batch(batch: pa.RecordBatch) -> dict:
        return {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": [extract(x, learnt.value) for x in batch.column("html").to_pylist()]}

    return map_arrow(keep, per_batch, schema).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
