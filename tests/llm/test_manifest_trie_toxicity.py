"""Merkle manifest, prefix trie and toxicity against brute force and on awkward tables."""

import hashlib
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from portflow.llm import merkle, prefix_trie, toxicity

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Merkle manifest -------------------------------------------------------------------------------------------------------

DOCS = "doc_id long, source string, lang string, n_chars long, text string, tree string, leaf string, block int"


def odd_documents(spark):
    long = "Grüße, WORLD \U0001f389 " * 20_000
    rows = [(1, "a", "en", 3, "Abc"), (1, "a", "en", 3, "Abc"), (1, "b", "en", 3, "ABC"), (None, None, None, None, None), (None, "x", "en", None, "NULL id"), (7, None, "", 0, ""),
            (-4, "s", None, 1, "Negative"), (12, "s", None, 1, long)] + [(100 + k, "hot", "de", k, f"Text {k}") for k in range(75)]
    return spark.createDataFrame([(*r, "t", "l", 1) for r in rows], DOCS).repartition(5)


def merkle_by_hand(rows):
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of (doc_id, source, lang, n_chars, text)."""
    def leaf(r):
        return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in r))

    def tree(leaves):
        levels = [leaves]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][k:k + 8])) for k in range(0, len(levels[-1]), 8)])
        return levels

    def path(levels, k):
        out = []
        for row in levels[:-1]:
            low = k // 8 * 8
            out.append(("".join(row[low:k]), "".join(row[k + 1:low + 8])))
            k //= 8
        return out

    by_lang = defaultdict(list)
    for r in rows:
        by_lang[r[2]].append(r)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    for own in by_lang.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {x: tree([leaf(r) for r in by_lang[x]]) for x in langs}
    top = tree([trees[x][-1][0] for x in langs])
    out = []
    for j, x in enumerate(langs):
        for k, r in enumerate(by_lang[x]):
            way = path(trees[x], k) + path(top, j)
            folded = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                folded = leaf((*r[:4], re.sub("[A-Z]", lambda m: m[0].lower(), r[4])))
            for before, after in way:
                folded = sha(before + folded + after)
            out.append((r[0], leaf(r), trees[x][-1][0], top[-1][0], sha("".join(b + a for b, a in way)), folded, folded == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [8192, 11, 1])
def test_manifest_equals_brute_force(spark, block):
    docs = odd_documents(spark)
    want = merkle_by_hand([tuple(r)[:5] for r in docs.collect()])
    assert sorted(map(tuple, merkle.manifest(docs, block).collect()), key=str) == want
    assert {r[-1] for r in want} == {True, False}


def test_manifest_sql_and_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert sorted(map(tuple, merkle.manifest(docs, 50).collect()), key=str) == sorted(con.sql(merkle.oracle()).fetchall(), key=str)
    assert merkle.manifest(docs.limit(0)).collect() == []


@pytest.mark.parametrize("total", [1, 2, 8, 9, 64, 65, 1000])
def test_octopus_multiproof_is_enough_and_least(total):
    leaves = [sha(str(k)) for k in range(total)]
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][k:k + 8])) for k in range(0, len(levels[-1]), 8)])
    rng = np.random.default_rng(total)
    for _ in range(20):
        first = int(rng.integers(total))
        count = int(rng.integers(1, total - first + 1))
        gaps = {(level, int(k)) for level, ks in enumerate(merkle.missing(np.arange(first, first + count), total)) for k in ks}
        given = {x: levels[x[0]][x[1]] for x in gaps}
        rows, root = merkle.derive(first, leaves[first:first + count], total, given)
        assert root == levels[-1][0]
        assert all(merkle.fold(leaves[first + k], way) == root for k, way in enumerate(merkle.expand(first, count, rows)))
        # none can be left out, none follows from the leaves of the run
        assert not any(first <= k * 8 ** level and min((k + 1) * 8 ** level, total) <= first + count for level, k in gaps)
        for x in list(given)[:5]:
            with pytest.raises(KeyError):
                merkle.derive(first, leaves[first:first + count], total, {k: v for k, v in given.items() if k != x})


def test_scattered_multiproof():
    gaps = merkle.missing(np.array([3, 3, 70]), 80)
    assert [g.tolist() for g in gaps] == [[0, 1, 2, 4, 5, 6, 7, 64, 65, 66, 67, 68, 69, 71], [1, 2, 3, 4, 5, 6, 7, 9], []]


def test_fringes_give_the_tree():
    leaves = [sha(str(k)) for k in range(100)]
    nodes = [x for s in range(0, 100, 7) for x in merkle.fringe(s, leaves[s:s + 7], 100)]
    assert len({x[:2] for x in nodes}) == len(nodes)
    spans = sorted((k * 8 ** level, min((k + 1) * 8 ** level, 100)) for level, k, _ in nodes)
    assert [a for a, _ in spans] == [0, *(b for _, b in spans[:-1])] and spans[-1][1] == 100


# prefix trie -----------------------------------------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, path int, words int, node string"


def odd_conversations(spark):
    rows = [(k, 0, "user", "the same first turn") for k in range(0, 90)]
    rows += [(k, t, "assistant", f"reply {t} {'x ' * (k % 3)}") for k in range(0, 90) for t in range(1, 1 + k % 5)]
    rows += [(200, t, None, "deep") for t in range(60)] + [(203, t, None, "deep") for t in range(59)] + [(-3, 1, "user", None), (-3, None, "user", "first"), (-21, 0, None, None)]
    rows += [(300, 5, "a", "tie one"), (300, 5, "a", "tie two"), (300, 5, "a", "tie two"), (None, 0, "user", "nobody's"), (417, 3, "", "alone")]
    return spark.createDataFrame([(*r, 1, 2, "n") for r in rows], TURNS).repartition(4)


def trie_by_hand(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0), sha(f"{len(role.encode())}:{role}{text}")[:32], (role, text)))
    own = {c: [x[2] for x in sorted(t)] for c, t in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - int(np.fmod(c, 20)), [])[:h] + turns[h:])
    nodes = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes[turns[:d]].append(c)
    kids = defaultdict(list)
    for x in nodes:
        if x:
            kids[x[:-1]].append(x)
    below = {}
    for x in sorted(nodes, key=len, reverse=True):
        saved = (len(nodes[x]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", x[-1][1])) if x else 0
        below[x] = (sum(below[k][0] for k in kids[x]) or 1, saved + sum(below[k][1] for k in kids[x]))
    return sorted(((min(m), len(x), min(nodes[x[:-1]]) if x else None, len(m), len(kids[x]), *below[x], sha(",".join(str(c) for c in sorted(m) if built[c] == x))) for x, m in nodes.items()), key=str)


@pytest.mark.parametrize("bounds", [(), (9, 40, 10), (8, 10_000, 2)])
def test_trie_equals_brute_force(spark, bounds):
    conversations = odd_conversations(spark)
    want = trie_by_hand([tuple(r)[:4] for r in conversations.collect()])
    assert sorted(map(tuple, prefix_trie.digest(prefix_trie.prefix_trie(conversations, *bounds)).collect()), key=str) == want


def test_trie_sql_and_empty(spark):
    conversations = spark.read.parquet(f"{SF}/conversations.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    assert sorted(map(tuple, prefix_trie.digest(prefix_trie.prefix_trie(conversations, 16, 100, 6)).collect()), key=str) == sorted(con.sql(prefix_trie.oracle()).fetchall(), key=str)
    assert prefix_trie.prefix_trie(conversations.limit(0)).collect() == []


def test_long_end_lists_are_hashed_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS_PER_CHUNK", 3)
    whole = spark.createDataFrame([(k, ["a" * 32], [1]) for k in range(50)], "conv_id long, path array<string>, words array<long>").repartition(3)
    assert [r["ends_sha256"] for r in prefix_trie.end_digests(whole).collect()] == [sha(",".join(map(str, range(50))))]


# toxicity --------------------------------------------------------------------------------------------------------------

def test_block_max_search_is_exact():
    rng = np.random.default_rng(1)
    rows = [(sorted(rng.choice(40, rng.integers(0, 6), replace=False).tolist()), None, int(rng.integers(0, 3))) for _ in range(300)]
    rows = [(at, rng.integers(1, 4, len(at)).tolist(), other) for at, _, other in rows]
    index = toxicity.Index(rng.uniform(1, 5, 41), rows, rng.integers(0, 2, 300), np.arange(300), block=7)
    dense = np.zeros((len(index.id), 41))
    for b, (codes, weights) in enumerate(index.postings):
        dense[b * 7:b * 7 + weights.shape[1], codes] = weights.T
    assert index.many.sum() == 300 and len(index.id) < 300
    vectors = [index.vector(*r) for r in rows]
    near, cosine = index.nearest(vectors, 10)
    for (at, x), found, value in zip(vectors, near, cosine):
        query = np.zeros(41)
        query[at] = x
        exact = np.round(dense @ query, 10)
        want = np.lexsort((np.arange(len(exact)), -exact))[:10]
        assert np.allclose(value, exact[want]) and (found == want).all()


def test_most_blocks_are_skipped():
    rows = [([k % 30], [1], 0) for k in range(600)] + [([k % 30, (k + 1) % 30], [1, 2], 1) for k in range(600)]
    index = toxicity.Index(np.ones(31), rows, np.zeros(1200), np.arange(1200), block=2)
    seen = []
    index.postings = [_Seen(p, seen, b) for b, p in enumerate(index.postings)]
    index.nearest([index.vector([4], [1], 0)], 2)
    assert 0 < len(seen) < len(index.postings) / 3


class _Seen(tuple):
    def __new__(cls, pair, seen, b):
        out = super().__new__(cls, pair)
        out.seen, out.b = seen, b
        return out

    def __iter__(self):
        self.seen.append(self.b)
        return super().__iter__()


def test_isotonic_rises_and_keeps_the_mean():
    rng = np.random.default_rng(2)
    x, y = rng.uniform(size=200).round(2), rng.integers(0, 2, 200)
    at, value = toxicity.isotonic(x, y.astype(float))
    assert (np.diff(at) > 0).all() and (np.diff(value) > 0).all()
    assert toxicity.isotonic(np.array([0.0, 1.0, 2.0]), np.array([1.0, 0.0, 1.0]))[1].tolist() == [0.5, 1.0]


def test_held_out_toxicity(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.score_toxicity(docs, labels).join(labels, "doc_id").where("held_out AND quality = 1").select("toxic", "score", "predicted").collect()
    hit = [r["toxic"] for r in rows if r["predicted"]]
    assert sum(hit) >= 0.97 * len(hit) and sum(hit) >= 0.9 * sum(r["toxic"] for r in rows)


def test_frequencies_cover_all_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").repartition(3)
    terms = ["the", "achli*", "der"]
    counts = toxicity.frequencies(toxicity.counted(docs, terms), 3)
    own = [{t for w in toxicity.words_of(r["text"].encode()) for t in toxicity.terms_of(w)} for r in docs.collect()]
    assert counts[:3].tolist() == [sum(t in x for x in own) for t in terms]


def test_odd_tables_are_scored(spark):
    schema = "doc_id long, text string, lang string, score double, at int, terms string"
    texts = [(k, f"you stupid clown, {k}" if k % 2 else f"what a fine day it is {k}") for k in range(60)] + [(900, None), (901, ""), (None, "stupid clown"), (902, "Stupid " * 90_000), (5, "a second text")]
    docs = spark.createDataFrame([(*t, "en", 0.1, 1, "x") for t in texts], schema).repartition(3)
    labels = spark.createDataFrame([(k, k % 2, 1) for k in range(60)] + [(None, 1, 1), (900, None, 0), (7, 1, 1)], "doc_id long, toxic int, quality int")
    rows = toxicity.score_toxicity(docs, labels).collect()
    assert len(rows) == len(texts) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] != 5}
    assert by_id[901]["score"] == by_id[900]["score"] < 0.5 < by_id[902]["score"] and by_id[None]["predicted"] == 1 and "stupid" in by_id[902]["terms"]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows if r["doc_id"] is not None)
    assert toxicity.score_toxicity(docs.limit(0), labels).collect() == []
    assert {r["score"] for r in toxicity.score_toxicity(docs, labels.limit(0)).collect()} == {0.5}
