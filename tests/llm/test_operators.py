"""The dealt operators against brute force and on awkward tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from portflow.llm import context_mixing, decontamination, html_region, line_dedup, neighbours, packing, pii, quality_rules, simhash, suffix_dedup
from portflow.llm.components import connected_components
from portflow.llm.tokens import WordBpe

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_words long, kept boolean, _m string, score double"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and extra columns whose names clash."""
    long = "the quick brown fox jumps over a lazy dog and " * 3000
    copied = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty twenty-one"
    rows = [(1, copied, "en", "a"), (2, copied, "en", "a"), (2, copied, "en", "a"), (3, None, None, None), (None, copied, "xx", "a"), (4, "", "en", "b"),
            (5, "   \n\t ", "en", None), (6, long, "en", "b"), (7, "Été \U0001f389 naïve <|endoftext|> 3.14 don't 中文 \x00x", "fr", "b"), (8, "word", "de", "c"),
            (None, None, None, None), (9, copied.upper() + " more", "en", "c"), (10, "x" * 5000, "en", "c")]
    return spark.createDataFrame([(*r, 1, True, "m", 0.5) for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# 1 -------------------------------------------------------------------------------------------------------------------

def base_rules(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    hit = {j for i in range(len(w) - 7) if seen[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit), len(w) < 20 or 100 * len(hit) > 30 * len(w))


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_quality_base_counts(request, which):
    df = request.getfixturevalue(which)
    out = quality_rules.quality_rules(df)
    got = rows(out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
    assert got == sorted(((d, *base_rules(t)) for d, t in texts(df)), key=str)
    assert out.where("kept and base_failed").count() == 0 and out.where("kept is null").count() == 0


def test_quality_verdict_and_pipeline_form(spark, docs, odd):
    junk = " ".join(f"{a}{b}" for a, b in zip("中文字符测试" * 10, "" * 10))
    df = spark.createDataFrame([(1, junk, "en"), (2, docs.where("n_chars > 2000").first()["text"], "en")], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(df).collect()}
    assert not got[1]["kept"] and got[1]["fallback_share"] > 0.05
    assert got[2]["base_failed"] or got[2]["kept"]
    kept = quality_rules.keep_quality(odd)
    assert kept.columns == odd.columns
    want = quality_rules.quality_rules(odd).where("kept").select("doc_id")
    assert rows(kept.select("doc_id")) == rows(want)


def test_repeated_words_in_long_runs():
    assert quality_rules.repeated_words(np.arange(7)) == 0
    assert quality_rules.repeated_words(np.zeros(9, np.int64)) == 9
    assert quality_rules.repeated_words(np.r_[np.arange(8), 99, np.arange(8)]) == 16


# 2 -------------------------------------------------------------------------------------------------------------------

def test_token_ids_are_the_librarys(docs, odd):
    path = public_tokenizers.path("word_bpe_49k.json")
    own, library = WordBpe(path), Tokenizer.from_file(path)
    for _, t in texts(docs) + texts(odd):
        if t:
            assert np.frombuffer(own.ids(t.encode()), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_packing_round_trip(request, which):
    df = request.getfixturevalue(which)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for d, t in texts(df):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        want.update((d, s, n, zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes()), len(ids)) for s, n in packing.cuts(len(ids), 4096, 512))
    got = packing.pack(df, group_windows=4 if which == "odd" else packing.GROUP_WINDOWS).collect()
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == want
    windows = {}
    for r in got:
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096
    if which == "docs":
        total = sum(r["length"] for r in got)
        assert total / (4096 * len(windows)) > 0.95


def test_differencing_is_balanced_and_grows():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 512, 700)
    window, sums = packing.balanced(sizes, 4096)
    assert np.array_equal(np.bincount(window, sizes, len(sums)).astype(int), sums) and sums.max() <= 4096
    assert sums.max() - sums.min() < 64
    window, sums = packing.balanced(np.array([3000, 3000, 3000]), 4096)  # two windows would do for the sum, not for the parts
    assert len(sums) == 3


# 3 -------------------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("which", ["docs", "odd"])
def test_context_mixing_base_score(request, which):
    df = request.getfixturevalue(which)
    count, per = Counter(), []
    for d, t in texts(df):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + ["\n"]
        out = zlib.crc32(b"" if d is None else str(d).encode()) % 7 == 2
        per.append((d, out, w))
        if not out:
            count.update(w)
    n, v = sum(count.values()), len(count)
    want = sorted(((d, out, len(w), sum(count[x] > 0 for x in w), n, sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w)) for d, out, w in per), key=str)
    got = context_mixing.score_texts(df).collect()
    mine = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got), key=str)
    assert [x[:5] for x in mine] == [x[:5] for x in want]
    assert np.allclose(sorted(x[5] for x in mine), sorted(x[5] for x in want))
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    if which == "docs":
        held = [r for r in got if r["held_out"]]
        assert sum(r["bits_per_byte"] for r in held) / len(held) < 4.0


def test_bit_model_is_a_distribution():
    tables = context_mixing.empty_tables()
    words = [b"the", b"then", b"of", context_mixing.END]
    context_mixing.add_counts(tables, words, np.array([50, 3, 20, 5]))
    ready, weights = context_mixing.Stretched(tables), np.full((context_mixing.GATES, len(context_mixing.ORDERS)), 0.3)
    # the first byte's probabilities over all 256 bytes add up to one: take words of one byte, without what follows
    nodes = context_mixing.Nodes(np.arange(256).astype(np.uint8), np.arange(1, 257))
    total = np.zeros(256)
    for bit, where in nodes.bits():
        x, gate = ready.inputs(where)
        z = sum(weights[:, k][gate] * x[k] for k in range(len(x)))
        total -= np.log1p(np.exp(np.where(bit > 0, -z, z)))
    assert abs(np.exp(total).sum() - 1) < 1e-6
    lp = context_mixing.log_probability(ready, weights, [b"the", b"xqz"])
    assert lp[0] > lp[1]


# 4 -------------------------------------------------------------------------------------------------------------------

def test_neighbour_voting_held_out(spark):
    base = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    got = {r["doc_id"]: r for r in neighbours.score_quality(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) and r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for d, r in got.items())
    test = [(got[r["doc_id"]]["predicted"], r["quality"]) for r in labels.collect() if got[r["doc_id"]]["held_out"]]
    assert sum(p == q for p, q in test) / len(test) > 0.9


def test_neighbour_voting_odd(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (6, 0, 0), (None, 1, 0), (2, None, 1)], "doc_id long, quality int, toxic int")
    got = neighbours.score_quality(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in neighbours.score_quality(odd, labels.limit(0)).collect()} == {0.5}


def test_exact_neighbours():
    rng = np.random.default_rng(1)
    model = neighbours.Model([], np.empty(0))
    model.vectors, model.labels = neighbours.unit(rng.standard_normal((200, neighbours.RANK)).astype(np.float32)), rng.integers(0, 2, 200).astype(np.float32)
    sparse = [(np.arange(5) + 7 * k, np.ones(5, np.float32)) for k in range(20)]
    cosine = neighbours.unit(neighbours.dense(sparse, model.idf) @ model.project) @ model.vectors.T
    for row, s in zip(cosine, model.score(sparse, 9)):
        near = np.argsort(-row)[:9]
        vote = np.exp(neighbours.SHARPNESS * (row[near] - 1))
        assert abs((vote * model.labels[near]).sum() / vote.sum() - s) < 1e-4


# 5 -------------------------------------------------------------------------------------------------------------------

def luhn(d):
    return sum(x - 9 if x > 9 else x for x in (int(c) * (1 + i % 2) for i, c in enumerate(reversed(d)))) % 10 == 0


def base_spans(t):
    digits = lambda m: re.sub("[^0-9]", "", m)
    rules = ((r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
             (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
             (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
             (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15))
    return [[f"{pii.KINDS[k]}:{m.start()}:{m.end()}" for m in re.finditer(p, t or "") if ok(m[0])] for k, (p, ok) in enumerate(rules)]


def test_personal_data(spark, docs, odd):
    extra = ["mail a@b.c_d@e.f x 1.2.3.4.5.6.7.8 256.1.1.1 00012.1.1.1 4111 1111 1111 1111 +1 (425) 555-9684.", "9" * 5000 + " " + "1 " * 9000, "a@b.c " * 900,
             "." * 9000 + "@x.y \U0001f389 a+b@c-d.e-f.g!", "john [at] example [dot] com, call 425-555-1234", " a@b.co"]
    df = docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text")).unionByName(
        spark.createDataFrame([(9000 + k, t) for k, t in enumerate(extra)], "doc_id long, text string"))
    out = pii.digest(pii.find_personal_data(df)).collect()
    want = Counter()
    for d, t in texts(df):
        s = base_spans(t)
        want[(d, *map(len, s), hashlib.sha256(",".join(sum(s, [])).encode()).hexdigest())] += 1
    assert Counter((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in out) == want
    spans = {r["doc_id"]: r["spans"] for r in out}
    assert spans[9004] == "email:0:27,phone:34:46"
    clean = [d for d, t in texts(docs) if spans[d] != ",".join(sum(base_spans(t), []))]
    assert len(clean) <= 1


def test_expectation_maximisation_finds_the_bad_labeler():
    rng, counts = np.random.default_rng(2), Counter()
    for _ in range(4000):
        true = rng.random() < 0.5
        right = rng.random(5) < np.array([0.95, 0.9, 0.9, 0.85, 0.5])
        counts[0, tuple(int(x) for x in np.where(right == true, 1, -1))] += 1
    prob, reliable = pii.expectation_maximisation(counts)
    assert reliable[0][0] > 0.9 and reliable[4][0] < 0.65
    assert prob[0, (1, 1, 1, 1, -1)] > 0.95 and prob[0, (-1, -1, -1, -1, 1)] < 0.05


# 6 -------------------------------------------------------------------------------------------------------------------

PAGE = ('<!DOCTYPE html><html><head><title>T x y</title><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">a b c</a></li></ul></nav><!-- ad -->'
        '<div class="ad">buy this now please</div>{open}<h1>Head&amp;line</h1><p><b>First  words\nof text.<br><p>Second &eacute; block of some words.</p>'
        '<div class="comments"><p>me too</p></div><p>End.</p>{close}<footer>&copy; site and many words here</footer></body></html>')


def test_html_region(spark):
    labelled = [(k, f"u{k}", PAGE.format(open="<article>", close="</article>")) for k in range(5)]
    pages = [*labelled, (6, None, None), (7, "e", ""), (8, "p", "plain words only"), (9, "n", PAGE.format(open="<section>", close="</section>")), (9, "n", "<p>a<p>b"), (10, "x", "<" * 5000),
             (11, "l", "<article>" + "<p>word word</p>" * 20000 + "</article>")]
    got = {}
    for r in html_region.extract_main_text(spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, text int")).collect():
        got.setdefault(r["page_id"], []).append(r)
    want = "Head&line\n\nFirst words of text.\n\nSecond é block of some words.\n\nEnd."
    assert all(got[k][0]["text"] == want and got[k][0]["n_chars"] == len(want) for k in range(5))
    assert got[6][0]["text"] == got[7][0]["text"] == "" and got[8][0]["text"] == "plain words only"
    assert got[9] and len(got[9]) == 2 and got[11][0]["n_chars"] == 20000 * 11 - 2


def test_best_region_is_the_maximum():
    rng = np.random.default_rng(5)
    for _ in range(50):
        s = rng.integers(-5, 6, 12).tolist()
        i, j = html_region.best_region(s)
        assert sum(s[i:j]) == max(0, max(sum(s[a:b]) for a in range(12) for b in range(a + 1, 13)))


# 7 -------------------------------------------------------------------------------------------------------------------

def contaminated(text, items):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hit, found = set(), set()
    for item, t in items:
        x = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        m = min(13, len(x))
        windows = {tuple(x[j:j + m]) for j in range(len(x) - m + 1)} if m else set()
        for i in range(len(w) - m + 1 if m else 0):
            if tuple(w[i:i + m]) in windows:
                hit |= set(range(i, i + m))
                found.add("" if item is None else str(item))
    return (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))


@pytest.mark.parametrize("block_bytes", [8 << 20, 9000])
def test_decontamination(spark, docs, odd, block_bytes):
    extra = [(500, "Seven eight NINE"), (501, "fourteen"), (502, None), (503, ""), (None, "naïve 3 14"), (500, "Seven eight NINE"), (504, "twenty twenty one the quick")]
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").unionByName(spark.createDataFrame(extra, "item_id long, text string"))
    df = docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    want = sorted(((d, *contaminated(t, items)) for d, t in texts(df)), key=str)
    assert rows(decontamination.contamination(df, bench, block_bytes=block_bytes)) == want
    assert rows(decontamination.drop_contaminated(df, bench).select("doc_id")) == sorted(((x[0],) for x in want if not x[5]), key=str)
    assert decontamination.contamination(odd, bench.limit(0)).where("n_hit > 0").count() == 0


# 8 -------------------------------------------------------------------------------------------------------------------

def test_line_dedup(spark):
    rows_ = [(k, f"menu | home\nown line {k}\n\n  \nmenu | home", "h", 1) for k in range(10)]
    rows_ += [(100 + k, "copied article\nof two lines", "h", 1) for k in range(20)]  # one page, however often it was copied
    rows_ += [(200, None, "h", 1), (201, "", "h", 1), (202, "menu | home\nrest", "other", 1), (203, "x", None, 1)] + [(300 + k, f"null host\n{k}", None, 1) for k in range(6)]
    df = spark.createDataFrame(rows_, "doc_id long, text string, source string, bad int")
    got = {r["doc_id"]: r for r in line_dedup.drop_boilerplate(df, ratio=0.5, n_lines="lines", n_dropped="dropped").collect()}
    assert got[3]["text"] == "own line 3\n\n  " and (got[3]["lines"], got[3]["dropped"]) == (5, 2)
    assert got[105]["text"] == "copied article\nof two lines" and got[202]["text"] == "menu | home\nrest"
    assert got[200]["text"] is None and got[201]["text"] == "" and got[302]["text"] == "2"
    assert line_dedup.drop_boilerplate(df).columns == df.columns and line_dedup.drop_boilerplate(df.limit(0)).count() == 0


def test_small_hosts_lose_their_notices(spark):
    """The ratio holds on hosts of any size: all pages of a host with two or four, but no line of a single page."""
    rows_ = [(10 * n + k, f"notice\nown line {k}", f"h{n}") for n in (1, 2, 4) for k in range(n)] + [(1000 + k, f"{'pair' if k < 2 else 'six' if k < 8 else 'own'}{k if k >= 8 else ''}\nline {k}", "big") for k in range(100)]
    df = spark.createDataFrame(rows_, "doc_id long, text string, source string")
    got = {r["doc_id"]: r["text"] for r in line_dedup.drop_boilerplate(df).collect()}
    assert got[10] == "notice\nown line 0" and got[20] == "own line 0" and [got[40 + k] for k in range(4)] == [f"own line {k}" for k in range(4)]
    assert got[1000] == "pair\nline 0" and got[1002] == "six\nline 2"   # beside one of them 1 and 5 of 100 pages: not above 5 %


def test_line_dedup_with_and_without_broadcast(docs, odd):
    for df, ratio in ((docs, line_dedup.RATIO), (odd, 0.3)):
        both = [line_dedup.drop_boilerplate(df, ratio=ratio, n_dropped="gone", broadcast_bytes=most) for most in (line_dedup.BROADCAST_BYTES, -1)]
        assert rows(both[0]) == rows(both[1])


# 9 -------------------------------------------------------------------------------------------------------------------

def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    s = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def by_brute_force(pairs):
    fps = sorted({f for _, f in pairs})
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    least = {}
    for d, f in pairs:
        if d is not None:
            least[find(f)] = min(least.get(find(f), d), d)
    return sorted(((d, f"{f:016x}", least.get(find(f))) for d, f in pairs), key=str)


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_simhash(request, which):
    df = request.getfixturevalue(which)
    want = by_brute_force([(d, fingerprint(t)) for d, t in texts(df)])
    assert rows(simhash.near_duplicates(df, tile=3)) == want
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    # one row per component of the rows that have an id, with the least id
    named = [(d, fingerprint(t)) for d, t in texts(df) if d is not None]
    groups = {}
    for d, f in named:
        linked = [g for g in groups if any((f ^ x).bit_count() <= 2 for x in groups[g][0])]
        members = [groups.pop(g) for g in linked]
        groups[f] = (set().union({f}, *(m[0] for m in members)), min([d, *(m[1] for m in members)]))
    assert rows(kept.select("doc_id").where("doc_id is not null")) == sorted(((least,) for _, least in groups.values()), key=str)
    assert kept.where("doc_id is null").count() == df.where("doc_id is null").count()


def test_unlike_texts_of_one_id_both_stay(spark):
    texts_ = [(1, "alpha beta gamma delta", "b"), (1, "quite other words stand here", "x"), (2, "alpha beta gamma delta", "x"), (1, "alpha beta gamma delta", "a")]
    df = spark.createDataFrame([(*t, 1) for t in texts_], "doc_id long, text string, source string, text_key int").repartition(3)
    kept = simhash.keep_one(df).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == [(1, "alpha beta gamma delta"), (1, "quite other words stand here")]
    again = simhash.keep_one(df.repartition(2)).collect()
    assert sorted(map(tuple, kept)) == sorted(map(tuple, again)) and kept[0].asDict().keys() == {"doc_id", "text", "source", "text_key"}
    assert simhash.keep_one(df.limit(0)).collect() == []


def test_simhash_links_chains(spark):
    rng = np.random.default_rng(4)
    fps = [int(x) for x in rng.integers(0, 1 << 63, 300)]
    for k in range(200):
        fps.append(fps[-1] ^ (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(64))))
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in set(fps)]
    got = {r["node"]: r["root"] for r in connected_components(simhash.links(spark.createDataFrame(signed, "fp long"), tile=16)).collect()}
    groups = {}
    for f in set(fps):
        s = f - (1 << 64) if f >> 63 else f
        groups.setdefault(got.get(s, s), set()).add(f)
    want = {}
    for d, h, c in by_brute_force([(f, f) for f in set(fps)]):
        want.setdefault(c, set()).add(d)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


# 10 ------------------------------------------------------------------------------------------------------------------

def cut(pairs, length=50):
    least = {}
    for d, t in pairs:
        b = (t or "").encode()
        if d is not None:
            for i in range(len(b) - length + 1):
                least[b[i:i + length]] = min(least.get(b[i:i + length], d), d)
    out = []
    for d, t in pairs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1 if d is not None else 0):
            if least[b[i:i + length]] < d:
                gone[i:i + length] = b"\x01" * length
        out.append((d, len(b), sum(gone), len(re.findall(b"\x01+", bytes(gone))), hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def test_suffix_dedup(spark, docs, odd):
    rng = np.random.default_rng(6)
    passage = "".join(rng.choice(list("abcde "), 400))
    extra = [(8000 + k, "".join(rng.choice(list("abcdefgh "), 60)) + passage[k:k + 49 + k] + "é" * int(rng.integers(60))) for k in range(60)]
    df = docs.select("doc_id", "text").unionByName(odd.where("doc_id is null or doc_id <> 6").select("doc_id", "text")).unionByName(
        spark.createDataFrame(extra, "doc_id long, text string")).repartition(5)
    assert rows(suffix_dedup.digest(suffix_dedup.dedup_substrings(df))) == cut(texts(df))


def test_multikey_order():
    rng = np.random.default_rng(7)
    x = rng.integers(97, 99, (500, 21)).astype(np.uint8)
    order = suffix_dedup.multikey_order(x)
    assert [x[k].tobytes() for k in order] == sorted(r.tobytes() for r in x)


# all -----------------------------------------------------------------------------------------------------------------

def test_empty_tables(spark, odd):
    none, labels = odd.limit(0), spark.createDataFrame([], "doc_id long, quality int")
    for out in (quality_rules.quality_rules(none), packing.pack(none), context_mixing.score_texts(none), neighbours.score_quality(none, labels), pii.find_personal_data(none),
                decontamination.contamination(none, spark.createDataFrame([], "item_id long, text string")), simhash.near_duplicates(none), suffix_dedup.dedup_substrings(none),
                html_region.extract_main_text(spark.createDataFrame([], "page_id long, url string, html string"))):
        assert out.count() == 0


def test_packing_refuses_long_pieces(docs):
    with pytest.raises(ValueError):
        packing.pack(docs, capacity=100, piece=200)
