"""Findings of round 3 on operator 3: what a worker holds, and how often a pass runs."""

import random
import weakref
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import functions as F

from portflow.llm import context_mixing as cm
from portflow.llm.blocks import passed


def test_a_pass_over_training_text_runs_once(spark):
    ran = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            for k in batch.column("id").to_pylist():
                ran.add(1)
                yield {"key": [k % 2], "part": [k], "body": [cm._press_planes(np.full(cm.CHUNK, float(k)))]}

    partial = passed(spark.range(0, 70, 1, 70).select(F.col("id")), run, cm._TABLES)
    tables = cm.context_tables(partial, (15, 15))
    assert ran.value == 70
    assert [(t.shape, t.min(), t.max()) for t in tables] == [((1 << 15, 2), s, s) for s in (sum(range(0, 70, 2)), sum(range(1, 70, 2)))]


def test_one_block_at_a_time_is_in_memory(monkeypatch):
    from tests.llm.test_context_mixing import stream_of
    rng = random.Random(2)
    texts = [" ".join(rng.choices("abcdef", k=50)).encode() for _ in range(8)]
    counts = Counter(w for t in texts for w in t.split()) + Counter({cm.END: 8})
    code = cm.Code(dict(counts), sum(counts.values()) + 5)
    train = [i for i in range(100) if not cm.held_out(i)][:8]
    made, rows = [], []

    def kept(kind):
        class One(kind):
            def __init__(self, *args):
                assert not [x for x in made if x() is not None]
                made.append(weakref.ref(self))
                super().__init__(*args)
        return One

    whole = cm.Stream
    monkeypatch.setattr(cm, "Stream", lambda row, code: rows.append(row) or whole(row, code))
    stream_of(texts, train, code)
    row = rows[0] | {"sizes": [len(t) for t in texts], "n_known": train, "base_score": [0.0] * 8}
    block = {"block": "b", "ids": train, "sizes": [len(t) for t in texts], "body": cm.zstandard.ZstdCompressor().compress(b"".join(texts))}
    monkeypatch.setattr(cm, "Stream", kept(whole))
    monkeypatch.setattr(cm, "Tokens", kept(cm.Tokens))
    monkeypatch.setattr(cm, "rows", iter)
    tables = [np.ones((1 << b, 2), np.float32) for b in (8, 8, 8)]
    code, mixer, weights = SimpleNamespace(value=code), SimpleNamespace(value=cm.Mixer(tables)), np.full((cm.GATES * cm.KINDS, 3), 0.3)
    last = cm.refined(np.zeros((cm.GATES * cm.KINDS * cm.STEPS, 2)))
    passes = {"words": (cm._word_pass(4), block), "runs": (cm._run_pass(3), block), "learn": (cm._learn_pass(code, mixer, 3), row), "score": (cm._score_pass(code, mixer, weights, last, 400), row)}
    for name, (run, x) in passes.items():
        made.clear()
        assert list(run([x, dict(x), dict(x)])) and len(made) == 3, name


def train_block(texts, name="b"):
    ids = [i for i in range(1000) if not cm.held_out(i)][:len(texts)]
    return {"block": name, "ids": ids, "sizes": [len(t) for t in texts], "body": cm.zstandard.ZstdCompressor().compress(b"".join(texts))}


def table_of(rows, schema):
    import pyarrow as pa
    flat = [{c: row[c][k] for c in schema.fieldNames()} for row in rows for k in range(len(row["key"]))]
    return pa.Table.from_pylist(flat, schema=cm.to_arrow_schema(schema))


def test_words_are_exchanged_once_and_not_written_before(spark, monkeypatch):
    names, whole = [], cm.written
    monkeypatch.setattr(cm, "written", lambda df, name: names.append(name) or whole(df, name))
    assert cm.score_texts(spark.createDataFrame([(k, f"some words here {k}") for k in range(20)], "doc_id long, text string")).count() == 20
    assert "words" not in names and names.count("lexicon") == 1


def test_blocks_get_their_words_counts_and_spelling(monkeypatch):
    rng = random.Random(6)
    texts = [[" ".join(rng.choices([f"w{k}" for k in range(90)], k=40)).encode() for _ in range(4)] for _ in range(3)]
    blocks = [train_block(x, f"b{k}") for k, x in enumerate(texts)]
    monkeypatch.setattr(cm, "rows", iter)
    asked = table_of(list(cm._word_pass(2)(blocks)), cm._WORDS)
    count = Counter(w for x in texts for t in x for w in [*t.split(), cm.END])
    frequent = {w: n for w, n in count.items() if n > 6}
    code = SimpleNamespace(value=cm.Code(frequent, sum(count.values())))
    tables = SimpleNamespace(value=cm.Stretched(cm.empty_tables()))
    weights = np.full((cm.GATES, len(cm.ORDERS)), 0.3)
    got = {}
    for key in set(asked.column("key").to_pylist()):
        lexicon = cm._merge(asked.filter(pc.equal(asked.column("key"), key))).to_pylist()
        for answer in cm._answer_words(code, tables, weights)(lexicon):
            for k, b in enumerate(answer["block"]):
                got[b, key] = cm._planes(answer["counts"][k], np.int64), cm._planes(answer["spelled"][k], np.float32)
    for block in blocks:
        words = cm.Tokens(block).words()
        counts, spelled = (np.concatenate([got[block["block"], k][j] for k in sorted(k for b, k in got if b == block["block"])]) for j in (0, 1))
        assert counts.tolist() == [count[w] for w in words]
        assert [x < 0 for x in spelled] == [w not in frequent for w in words]


def test_runs_travel_as_symbols_and_mean_the_same(monkeypatch):
    rng = random.Random(7)
    words = [f"w{k}" for k in range(400)]
    blocks = [train_block([" ".join(rng.choices(words, range(400, 0, -1), k=900)).encode() for _ in range(6)], f"b{k}") for k in range(2)]
    monkeypatch.setattr(cm, "rows", iter)
    count = Counter(w for b in blocks for w in cm.unpacked(b["body"]).split())
    code = SimpleNamespace(value=cm.Code({w: n for w, n in count.items() if n > 9}, sum(count.values())))
    coded, plain = (table_of(list(cm._run_pass(1, c)(blocks)), cm._RUNS) for c in (code, None))
    size = [sum(len(x) for c in ("word", "rare") for x in t.column(c).to_pylist()) for t in (coded, plain)]
    assert size[0] < 0.7 * size[1]
    for key in (0, 1):
        a, b = (cm._answer_runs(code)(t.filter(pc.equal(t.column("key"), key))).to_pylist() for t in (coded, plain))
        assert a == b and len(a) == 2


def test_faster_look_ups_find_the_same():
    rng = np.random.default_rng(9)
    for key in (rng.integers(0, 50, 400, np.uint64) * np.uint64(0x9E3779B97F4A7C15), rng.integers(0, 9, 300, np.uint64), np.zeros(0, np.uint64)):
        assert all(np.array_equal(a, b) for a, b in zip(cm.distinct(key), np.unique(key, return_index=True, return_inverse=True)))
    words = [b"w%d" % k for k in range(3000)]
    code = cm.Code({w: 3 for w in words[:2500]}, 9000)
    sure, all_ = code.sure_symbols(cm.hashed(words)), code.symbols(cm.hashed(words))
    assert np.all((sure == all_) | (sure == 0)) and (sure == all_).mean() > 0.98
    outcome, doc = rng.integers(0, 4, 60).astype(np.uint8), np.sort(rng.integers(0, 7, 60))
    short, long = cm.recent(outcome, doc)
    for i in range(60):
        past = [(j, int(outcome[i - j])) for j in range(1, 9) if i >= j and doc[i - j] == doc[i]]
        assert (short[i], long[i]) == tuple(sum(o << 2 * j for j, o in past if j <= most) for most in (4, 8))
