"""Operator 3's parts against brute force, and what its score must tell apart."""

import random
from collections import Counter

import numpy as np

from portflow.llm import context_mixing as cm


def stream_of(texts, ids, code, flags=None):
    """A block's decisions without an exchange."""
    import zstandard
    body = zstandard.ZstdCompressor().compress(b"".join(texts))
    row = {"ids": ids, "sizes": [len(t) for t in texts], "body": body}
    t = cm.Tokens(row)
    flags = np.zeros(len(t.at), np.uint8) if flags is None else flags
    return t, cm.Stream({"ids": ids, "n_tokens": t.size.tolist(), "at": cm._press_planes(t.at.astype(np.uint32)), "word": cm._press((t.hashes >> np.uint64(48)).astype(np.uint16)),
                         "symbol": cm._press_planes(code.symbols(t.hashes).astype(np.uint32)), "spelled": cm._press_planes(np.full(len(t.hashes), -20, np.float32)), "flags": cm._press(flags)}, code)


def test_huffman_code_is_complete_and_short():
    counts = {b"w%d" % k: 1000 // (k + 1) + 2 for k in range(500)} | {cm.END: 70}
    code = cm.Code(counts, sum(counts.values()) + 40)
    assert abs(sum(2.0 ** -code.size) - 1) < 1e-12 and code.nodes == len(code.size) - 1
    weight = np.array([40, *sorted(counts.values(), reverse=True)])
    p = weight / weight.sum()
    entropy = -(p * np.log2(p)).sum()
    assert entropy <= (p * code.size).sum() < entropy + 1
    assert code.symbols(cm.hashed([b"w0", b"nowhere"])).tolist()[1] == 0


def test_next_token_probabilities_add_up_to_one():
    rng = random.Random(5)
    words = [b"w%d" % k for k in range(40)]
    texts = [b" ".join(rng.choices(words, range(40, 0, -1), k=60)) for _ in range(30)]
    counts = Counter(w for t in texts for w in t.split()) + Counter({cm.END: 30})
    code = cm.Code(dict(counts), sum(counts.values()) + 5)
    _, stream = stream_of(texts, [0] * 30, code)
    bits = (12, 12, 12, 12)
    tables = [np.zeros((1 << b, 2), np.float32) for b in bits]
    for _, _, bit, hashes in stream.decisions(np.ones(len(stream.base), bool)):
        for t, h, b in zip(tables, hashes, bits):
            np.add.at(t.reshape(-1), 2 * (h >> np.uint64(64 - b)).astype(np.int64) + bit, 1)
    mixer = cm.Mixer(tables)
    weights, scale, came = np.full((cm.GATES * cm.KINDS, 4), 0.3), np.zeros((cm.GATES * cm.KINDS, 4)), np.zeros((cm.GATES * cm.KINDS * cm.STEPS, 2), np.int64)
    cm.learn(mixer, stream, weights, scale, came)
    held = next(i for i in range(100) if cm.held_out(i))
    last = cm.refined(came)
    total = 0.0
    for nxt in [*words, cm.END, b"unheard"]:
        text = b"w0 w1" if nxt == cm.END else b"w0 w1 " + nxt
        _, s = stream_of([text], [held], code)
        s.base[:] = 0  # an escape counts once, without its spelling
        total += np.exp(cm.log_probabilities(mixer, s, weights, last)[2])
    assert abs(total - 1) < 1e-4


def test_expected_word_against_brute_force():
    rng = np.random.default_rng(8)
    n = 600
    before, word = rng.integers(0, 40, n).astype(np.uint32), rng.integers(0, 6, n).astype(np.uint32)
    own = rng.integers(0, 3, n)
    times = np.where(own > 0, own * rng.integers(1, 4, n), 0)
    got = cm.expected(before, word, own, times)
    seen = {}
    for b, w, t in zip(before.tolist(), word.tolist(), times.tolist()):
        seen.setdefault(b, Counter())[w] += t
    for b, w, o, g in zip(before.tolist(), word.tolist(), own.tolist(), got.tolist()):
        left = Counter(seen[b])
        left[w] -= o
        best = max(left.values())
        if best == 0:
            assert g == 0
            continue
        rest = sum(left.values()) - best
        first = min(k for k, v in left.items() if v == best)
        assert g & 1 == (first == w)
        assert (g >> 1) & 7 == sum(best >= x for x in cm.SURE) and g >> 4 == sum(rest >= x for x in cm.UNSURE)


def test_words_and_hashes():
    text = "Un été \x00x  a\ta\n\nlong".encode() + b"g" * 600_000 + b" end a"
    t, _ = stream_of([text, b"", b" \n", b"a"], [1, 2, 3, 4], cm.Code({cm.END: 4, b"a": 3}, 9))
    want = [w for x in (text, b"", b" \n", b"a") for w in [*x.lower().split(), cm.END]]
    words = t.words()
    assert [words[k] for k in t.at] == [w.replace(b"U", b"u") for w in want]
    assert np.array_equal(cm.hashed(words), t.hashes) and np.array_equal(cm.hashed([b"a"]), t.token[-2:-1])


def test_runs_count_own_and_other_texts():
    a, b = b"one two three four one two three", b"one two three"
    ids = [next(i for i in range(100) if not cm.held_out(i))] * 2
    row_t, _ = stream_of([a, b], ids, cm.Code({cm.END: 2, b"one": 3}, 5))
    at, own, n, which = cm.runs(row_t)
    words = [w for t in (a, b) for w in [*t.split(), cm.END]]
    for pos in range(len(words)):
        k = which[pos]
        assert words[at[k]] == words[pos] and row_t.before[at[k]] == row_t.before[pos]
    k = which[2]  # "one two" -> three: twice in the first text, once in the second
    assert (own[k], n[k]) == (2, 2) and (own[which[10]], n[which[10]]) == (1, 1)


def test_order_of_words_matters(spark):
    """Held-out texts of a grammar score better than their words in another order."""
    rng = random.Random(3)
    after = {k: rng.sample(range(300), 4) for k in range(300)}

    def text(n=120):
        k, out = rng.randrange(300), []
        for _ in range(n):
            out.append(f"w{k}")
            k = rng.choice(after[k])
        return " ".join(out)

    held = [i for i in range(4000) if cm.held_out(i)]
    train = [i for i in range(4000) if not cm.held_out(i)]
    rows, real = [(i, text()) for i in train[:600]], [text() for _ in range(60)]
    for k, t in enumerate(real):
        mixed = t.split()
        rng.shuffle(mixed)
        rows += [(held[2 * k], t), (held[2 * k + 1], " ".join(mixed))]
    got = {r["doc_id"]: r for r in cm.score_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert sum(got[held[2 * k]]["score"] > got[held[2 * k + 1]]["score"] for k in range(60)) >= 58
    # it beats the base score where there is something to learn
    assert sum(got[held[2 * k]]["score"] for k in range(60)) > 0.8 * sum(got[held[2 * k]]["base_score"] for k in range(60))


def test_texts_that_occur_twice_stand_out(spark):
    """Copies predict each other, held out or not; a text's own occurrence doesn't."""
    rng = random.Random(4)
    words = [f"w{k}" for k in range(3000)]
    rows = [(i, " ".join(rng.choices(words, k=100))) for i in range(400)]
    rows += [(1000 + i, t) for i, t in rows[:40]]
    got = {r["doc_id"]: r["bits_per_byte"] for r in cm.score_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    held = {i for i in got if cm.held_out(i)}
    seen = [i for i in got if (i < 40 and 1000 + i not in held) or (i >= 1000 and i - 1000 not in held)]
    once = [i for i in got if 40 <= i < 1000]
    assert max(got[i] for i in seen) < 0.5 * min(got[i] for i in once)


def test_without_training_text(spark):
    held = [i for i in range(100) if cm.held_out(i)][:3]
    got = cm.score_texts(spark.createDataFrame([(held[0], "some words here"), (held[1], ""), (held[2], None)], "doc_id long, text string")).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and np.isfinite(r["score"]) and r["score"] < 0 for r in got)
