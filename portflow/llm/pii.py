"""Personal data by weak supervision, in DataFrame functions only.

Strict patterns give the base spans of four kinds, and looser patterns give further candidates.  Labelers (pattern,
check digits and ranges, gazetteers, words before, characters around) vote on every candidate, or abstain.  Counts of
vote patterns, which are few however large the corpus is, go to the driver, where expectation-maximisation estimates
each labeler's reliability and a probability for each pattern; a logistic span classifier is trained on these and on
the spans' forms.  Candidates beyond the base that it accepts become spans; base spans always stay.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portflow.llm.common import written

KINDS = ("email", "ip", "card", "phone")
#: base patterns.  They match what the contract's patterns match, leftmost first; possessive runs and the look behind
#: only keep the search linear: a run that fails at its first character fails at its others too.
BASE = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[ -]?[0-9])++",
    r"\+[0-9][ ().0-9-]+[0-9]",
)
#: what a text must contain for its pattern to match at all
NEEDS = ("@", r"[0-9]\.[0-9]", "[0-9][ -]?[0-9]", r"\+[0-9]")
#: looser candidates of each kind, and what they need; a group is named, as ``_parts`` puts one more around the pattern
LOOSE = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:@|\[at\]|\(at\)|\{at\}) ?[A-Za-z0-9-]++(?: ?(?:\.|\[dot\]|\(dot\)|\{dot\}) ?[A-Za-z0-9-]++)++",
    r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    r"(?<![0-9.])[0-9]{4}(?<sep>[ .-])[0-9]{4}\k<sep>[0-9]{4}\k<sep>[0-9]{4}(?![0-9])",
    r"(?<![0-9+(.-])(?:00[0-9]{1,3}[ .-]?|\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
)
LOOSE_NEEDS = (r"@|\[at\]|\(at\)|\{at\}", "[0-9A-Fa-f]:[0-9A-Fa-f]", "[0-9][ .-][0-9]{4}", "[0-9][ .-][0-9]{4}")
#: gazetteers: common top-level domains, first digits of card networks, country calling codes
DOMAINS = "com|org|net|edu|gov|int|mil|info|biz|io|co|de|fr|es|uk|us|eu|it|nl|ch|at|be|pl|pt|ca|au|jp|cn|in|br|mx|ru|se|no|dk|fi"
NETWORKS = "4|5[1-5]|2[2-7]|3[47]|6"
CALLING = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
#: words that come before personal data
BEFORE = (r"(?:e-?mail|mailto|contact|write|correo|courriel|kontakt)\W*(?:\w+\W+)?$", r"(?:\bip\b|host|server|address|adresse|login)\W*(?:\w+\W+)?$",
          r"(?:card|visa|master|amex|credit|karte|carte|tarjeta)\W*(?:\w+\W+)?$", r"(?:phone|tel|call|fax|mobile|cell|whatsapp|telefon|t[eé]l[eé]phone|tel[eé]fono)\W*(?:\w+\W+)?$")
LABELERS = 5
CHUNK = 256
_MARK = "\ue000"
MAX_ROUNDS = 200
ACCEPT = 0.5


def _let(x: Column, then: Callable[[Column], Column]) -> Column:
    """``then(x)``, with ``x`` worked out once."""
    return F.get(F.transform(F.array(x), then), F.lit(0))


def _parts(text: Column, pattern: str, needs: str) -> Column:
    """The text split before and after each match; null where the pattern can't match."""
    clean = F.when(F.contains(text, F.lit(_MARK)), F.translate(text, _MARK, "?")).otherwise(text)
    has = F.contains(text, F.lit(needs)) if needs == "@" else F.rlike(text, F.lit(needs))
    return F.when(has, F.split(F.regexp_replace(clean, f"({pattern})", f"{_MARK}$1{_MARK}"), _MARK, -1))


_PLACE = "struct<start:bigint,end:bigint,value:string,before:string,after:string>"


def _places(parts: Column) -> Column:
    """Matches among the parts with their places in code points.

    Places are sums of lengths, added chunk by chunk so that very many matches cost no more than in proportion.
    """
    n = lambda x: F.length(x).cast("long")
    triples = F.transform(F.sequence(F.lit(0), ((F.size(parts) - 3) / 2).cast("int")), lambda i: F.struct(
        F.get(parts, 2 * i).alias("gap"), F.get(parts, 2 * i + 1).alias("value"), F.left(F.get(parts, 2 * i + 2), F.lit(4)).alias("after")))

    def add(acc: Column, t: Column) -> Column:
        start = acc["at"] + n(t["gap"])
        end = start + n(t["value"])
        place = F.struct(start.alias("start"), end.alias("end"), t["value"].alias("value"), F.right(t["gap"], F.lit(32)).alias("before"), t["after"].alias("after"))
        return F.struct(end.alias("at"), F.concat(acc["found"], F.array(place)).alias("found"))

    def chunk(all_: Column) -> Callable[[Column], Column]:
        zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{_PLACE}>").alias("found"))
        return lambda c: F.aggregate(F.slice(all_, c * CHUNK + 1, F.lit(CHUNK)), zero, add)

    def shifted(c: Column) -> Column:
        return F.transform(c["found"], lambda x: F.struct((x["start"] + c["by"]).alias("start"), (x["end"] + c["by"]).alias("end"), x["value"].alias("value"),
                                                          x["before"].alias("before"), x["after"].alias("after")))

    chunks = _let(triples, lambda t: F.transform(F.sequence(F.lit(0), ((F.size(t) - 1) / CHUNK).cast("int")), chunk(t)))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<struct<by:bigint,found:array<{_PLACE}>>>").alias("all"))
    placed = F.aggregate(chunks, zero, lambda acc, c: F.struct(
        (acc["at"] + c["at"]).alias("at"), F.concat(acc["all"], F.array(F.struct(acc["at"].alias("by"), c["found"].alias("found")))).alias("all")))
    return F.flatten(F.transform(placed["all"], shifted))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """The check digit is right (13 to 19 digits)."""
    worth = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(2 * d.cast("int") - F.when(d >= "5", 9).otherwise(0)))
    return F.when(F.length(digits).between(13, 19), F.aggregate(worth, F.lit(0), lambda a, x: a + x) % 10 == 0).otherwise(False)


def _octets(value: Column) -> Column:
    return F.forall(F.split(value, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.right(F.concat(F.lit("000"), p), F.lit(3)).cast("int") <= 255))


def _of_kind(kind: Column, cases: list[Column]) -> Column:
    out = F.when(kind == 0, cases[0])
    for k, c in enumerate(cases[1:], 1):
        out = out.when(kind == k, c)
    return out


def _valid(kind: Column, value: Column, digits: Column) -> Column:
    return _of_kind(kind, [F.lit(True), _octets(value), _luhn(digits), F.length(digits).between(9, 15)])


def _votes(kind: Column, base: Column, x: Column, digits: Column) -> Column:
    """1 for, -1 against, 0 abstains: pattern, check, gazetteer, words before, characters around."""
    yes = lambda c, no=0: F.when(c, 1).otherwise(no).cast("int")
    value = x["value"]
    check = _of_kind(kind, [yes(F.rlike(value, F.lit(r"\.[A-Za-z]{2,}$")), -1), yes(F.when(F.contains(value, F.lit(":")), True).otherwise(base), -1), yes(_luhn(digits), -1),
                            yes(F.length(digits).between(10, 13) & ~F.rlike(digits, F.lit("^(.)\\1+$")), -1)])
    gazetteer = _of_kind(kind, [yes(F.rlike(F.lower(value), F.lit(rf"(?:\.|dot\W) ?(?:{DOMAINS})$"))), yes(~F.rlike(value, F.lit(r"^(?:0|127|169\.254|22[4-9]|2[3-5][0-9])\.|:"))),
                                yes(F.rlike(digits, F.lit(f"^(?:{NETWORKS})")), -1), yes(F.rlike(digits, F.lit(rf"^(?:00)?(?:{CALLING})")))])
    context = _of_kind(kind, [yes(F.rlike(F.lower(x["before"]), F.lit(words))) for words in BEFORE])
    around = F.when(F.rlike(x["before"], F.lit(r"[A-Za-z0-9=&/#%$*|_.-]$")) | F.rlike(x["after"], F.lit(r"^[A-Za-z0-9=&/#%$*|_-]")), -1).otherwise(1).cast("int")
    return F.array(yes(base), check, gazetteer, context, around)


def _spans(hit: Column) -> Column:
    """Of one pattern: kind, start, end, value, base, votes, form (the length in steps of four, at most seven)."""
    def span(x: Column) -> Column:
        return _let(_digits(x["value"]), lambda d: F.struct(
            hit["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"), hit["base"].alias("base"),
            _votes(hit["kind"], hit["base"], x, d).alias("votes"), F.least(F.lit(7), ((x["end"] - x["start"]) / 4).cast("int")).alias("form")))

    def stays(x: Column) -> Column:
        return ~hit["base"] | _let(_digits(x["value"]), lambda d: _valid(hit["kind"], x["value"], d))

    return F.transform(F.filter(_places(hit["parts"]), stays), span)


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, base, loose: spans with their votes.  Loose candidates that touch a base span are left out."""
    text = F.coalesce(F.col("text"), F.lit(""))
    hits = F.array(*(F.struct(F.lit(k).alias("kind"), F.lit(base).alias("base"), _parts(text, pattern[k], needs[k]).alias("parts"))
                     for base, pattern, needs in ((True, BASE, NEEDS), (False, LOOSE, LOOSE_NEEDS)) for k in range(len(KINDS))))
    found = docs.select("doc_id", F.filter(hits, lambda h: F.coalesce(F.size(h["parts"]), F.lit(0)) >= 3).alias("hits"))
    spans = found.select("doc_id", F.flatten(F.transform("hits", _spans)).alias("spans"))
    split = spans.select("doc_id", F.filter("spans", lambda x: x["base"]).alias("base"), F.filter("spans", lambda x: ~x["base"]).alias("loose"))
    free = F.filter("loose", lambda x: ~F.exists("base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    return split.select("doc_id", "base", F.when(F.size("loose") > 0, free).otherwise(F.col("loose")).alias("loose"))


def _is_kind(kind: int) -> Callable[[Column], Column]:
    return lambda x: x["kind"] == kind


# --- on the driver: counts of patterns only ---------------------------------------------------------------------------

Pattern = tuple[int, tuple[int, ...], int]


def expectation_maximisation(counts: dict[tuple[int, tuple[int, ...]], int]) -> tuple[dict[tuple[int, tuple[int, ...]], float], list[tuple[float, float]]]:
    """Probability of each (kind, votes), and each labeler's reliabilities: right where it votes on true, on false spans.

    A labeler that abstains says nothing.  The start is the share of its votes that speak for the span.
    """
    prob = {p: (1 + sum(v > 0 for v in p[1])) / (2 + sum(v != 0 for v in p[1])) for p in counts}
    reliable = [(0.8, 0.8)] * LABELERS
    for _ in range(MAX_ROUNDS):
        prior = {}
        for kind in range(len(KINDS)):
            total = sum(n for p, n in counts.items() if p[0] == kind)
            prior[kind] = (1 + sum(n * prob[p] for p, n in counts.items() if p[0] == kind)) / (2 + total)
        reliable = []
        for j in range(LABELERS):
            voted = [(p[1][j] > 0, prob[p], n) for p, n in counts.items() if p[1][j]]
            on_true, on_false = sum(q * n for _, q, n in voted), sum((1 - q) * n for _, q, n in voted)
            # a labeler is taken to be better than a guess
            reliable.append((min(0.99, max(0.55, (4 + sum(q * n for yes, q, n in voted if yes)) / (5 + on_true))),
                             min(0.99, max(0.55, (4 + sum((1 - q) * n for yes, q, n in voted if not yes)) / (5 + on_false)))))
        new = {}
        for kind, votes in counts:
            odds = math.log(prior[kind] / (1 - prior[kind]))
            for (true, false), v in zip(reliable, votes):
                odds += 0 if not v else math.log(true / (1 - false)) if v > 0 else math.log((1 - true) / false)
            new[kind, votes] = 1 / (1 + math.exp(-odds))
        moved = max((abs(new[p] - prob[p]) for p in new), default=0.0)
        prob = new
        if moved < 1e-6:
            break
    return prob, reliable


def _features(kind: int, votes: tuple[int, ...], form: int) -> list[float]:
    return [1.0, *(float(kind == k) for k in range(len(KINDS))), *map(float, votes), form / 7]


def train_classifier(counts: dict[Pattern, int], rounds: int = 300, rate: float = 0.5, decay: float = 1e-3) -> list[float]:
    """Logistic weights from the patterns' counts and the probabilities that expectation-maximisation gives them."""
    votes: dict[tuple[int, tuple[int, ...]], int] = {}
    for (kind, v, _), n in counts.items():
        votes[kind, v] = votes.get((kind, v), 0) + n
    prob, _ = expectation_maximisation(votes)
    rows = [(_features(*p), prob[p[0], p[1]], math.log1p(n)) for p, n in sorted(counts.items())]
    total, width = sum(n for *_, n in rows) or 1.0, len(_features(0, (0,) * LABELERS, 0))
    w = [0.0] * width
    for _ in range(rounds):
        grad = [decay * x for x in w]
        for x, y, n in rows:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(w, x))))))
            for j, a in enumerate(x):
                grad[j] += n / total * (p - y) * a
        w = [a - rate * g for a, g in zip(w, grad)]
    return w


def _score(x: Column, w: list[float]) -> Column:
    z = F.lit(w[0]) + sum((F.when(x["kind"] == k, F.lit(w[1 + k])).otherwise(F.lit(0.0)) for k in range(len(KINDS))), F.lit(0.0))
    for j in range(LABELERS):
        z = z + F.lit(w[1 + len(KINDS) + j]) * F.get(x["votes"], F.lit(j))
    return 1 / (1 + F.exp(-(z + F.lit(w[-1] / 7) * x["form"])))


def find_personal_data(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """One row per document: doc_id, spans (kind, start, end, value, base, score), sorted by kind, then place.

    Places are code points, the end is exclusive.  Null and empty texts have no spans.  Repeated rows are searched
    each on its own.  A character U+E000 counts as a question mark.  Other columns are ignored; an empty table gives no
    rows.
    """
    found = written(candidates(docs.select("doc_id", "text")), "candidates")
    one = found.select(F.explode(F.concat("base", "loose")).alias("x")).groupBy("x.kind", "x.votes", "x.form").count()
    w = train_classifier({(r["kind"], tuple(r["votes"]), r["form"]): r["count"] for r in one.collect()})
    both = F.concat("base", F.filter("loose", lambda x: _score(x, w) >= accept))
    spans = F.transform(both, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"),
                                                 x["base"].alias("base"), _score(x, w).alias("score")))
    return found.select("doc_id", F.array_sort(spans).alias("spans"))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def digest(result: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 (of the base spans), spans (all of them)."""
    base = F.filter("spans", lambda x: x["base"])
    return result.select("doc_id", *(F.size(F.filter(base, _is_kind(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)),
                         F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
