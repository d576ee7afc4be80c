import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from loomlog.llm import lm_scoring as m
from loomlog.llm.hashing import range_hashes, shingle_hashes

SCHEMA = "doc_id long, text string, score int, word string, row int, doc string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def data():
    rnd = random.Random(12)
    out = []
    for i in range(600):
        vocab = [f"{p}{k}" for p in rnd.choice(["La", "lé", "x"]) for k in range(rnd.choice([5, 80]))]
        out.append((i if i % 40 else None, rnd.choice([" ", "\n", "  "]).join(rnd.choice(vocab) for _ in range(rnd.randint(0, 60)))))
    return [*out, (700, None), (701, ""), (702, "A a " * 30_000), (703, "x" * 200_000), out[1], out[1]]


def likelihood(counts, label):
    f = lambda x: x * math.log(x) if x > 0 else 0.0
    k = label.max() + 1
    pairs = np.zeros((k, k))
    np.add.at(pairs, (label[:, None], label[None, :]), counts)
    return sum(map(f, pairs.ravel())) - sum(map(f, pairs.sum(axis=1))) - sum(map(f, pairs.sum(axis=0)))


@pytest.mark.parametrize("lookup", [40, 1 << 18])
def test_base_score_and_model(spark, monkeypatch, lookup):
    monkeypatch.setattr(m, "LOOKUP", lookup)
    rows = data()
    df = spark.createDataFrame([(i, t, 1, "w", 1, "d") for i, t in rows], SCHEMA).repartition(4)
    got = m.score_documents(df).collect()
    c = Counter()
    for i, t in rows:
        if zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2:
            c.update([*words(t), None])
    total, distinct = sum(c.values()), len(c)
    want = []
    for i, t in rows:
        own = [*words(t), None]
        want.append((i, zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2, len(own), sum(c[w] > 0 for w in own), total, round(sum(math.log10((c[w] + 1) / (total + distinct + 1)) for w in own), 5)))
    assert sorted(((r["doc"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in got), key=str) == sorted(want, key=str)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def xlogx(x):
    return x * math.log(x) if x > 0 else 0.0


def brute_scores(rows):
    """The whole model from counts in dictionaries, given the exchange of the symbols and the hashes of the words."""
    import pyarrow as pa

    texts = []
    for i, t in rows:
        batch = pa.RecordBatch.from_arrays([pa.array([i], type=pa.int64()), pa.array([t], type=pa.string())], names=["doc", "text"])
        found = [(word.tolist(), group.tolist()) for _, _, word, group, _ in m.tokens(batch)]
        word, group = found[0] if found else ([], [])
        texts.append((i, m.held_out(i), list(zip(word, group))))
    c = Counter(w for _, held, t in texts if not held for w, _ in t)
    order = sorted(c, key=lambda w: (-c[w], w))
    head = {w: k for k, w in enumerate(sorted(order[: m.HEAD]))}
    symbol = lambda w, e: head.get(w, m.HEAD + e)
    counts = np.zeros((m.SYMBOLS, m.SYMBOLS))
    for _, held, t in texts:
        if not held:
            line = [m._END, *(symbol(*x) for x in t), m._END]
            for a, b in zip(line, line[1:]):
                counts[a, b] += 1
    g = m.exchange(counts)
    before, first, ends = {}, {}, Counter()
    for _, held, t in texts:
        if not held:
            last = m._END
            for w, e in t:
                before.setdefault(w, Counter())[int(g[last])] += 1
                first[w] = int(g[symbol(w, e)])
                last = symbol(w, e)
            ends[int(g[last])] += 1
    h = dict(first)

    def tables():
        pairs = np.zeros((m.CLASSES, m.CLASSES))
        for w, own in before.items():
            for k, n in own.items():
                pairs[k, h[w]] += n
        for k, n in ends.items():
            pairs[k, 0] += n
        return pairs

    gain = []
    for turn in range(m.WORD_ROUNDS):
        pairs = tables()
        size = pairs.sum(axis=0)
        gain.append(sum(map(xlogx, pairs.ravel())) - sum(map(xlogx, size)))
        new = {}
        for w, own in before.items():
            old = h[w]
            new[w] = old
            if int(m.mix(np.array([w], np.int64).view(np.uint64))[0] >> np.uint64(40)) & 1 != turn % 2:
                continue
            best = sum(xlogx(pairs[k, old]) - xlogx(pairs[k, old] - n) for k, n in own.items()) - xlogx(size[old]) + xlogx(size[old] - c[w]) + 1e-9
            for d in range(1, m.CLASSES):
                value = sum(xlogx(pairs[k, d] + n) - xlogx(pairs[k, d]) for k, n in own.items()) - xlogx(size[d] + c[w]) + xlogx(size[d])
                if d != old and value > best:
                    best, new[w] = value, d
        h = new
    pairs = tables()
    size = pairs.sum(axis=0)
    gain.append(sum(map(xlogx, pairs.ravel())) - sum(map(xlogx, size)))
    kinds = Counter(h.values())
    unigram = (size + 1) / (size + 1).sum()
    step = lambda a, b: math.log10((pairs[a, b] + m.BACKOFF * unigram[b]) / (pairs[a].sum() + m.BACKOFF))
    out = []
    for i, _, t in texts:
        last, score = m._END, 0.0
        for w, e in t:
            own = h.get(w, int(g[symbol(w, e)]))
            score += step(int(g[last]), own) + math.log10((c[w] + 0.5) / (size[own] + 0.5 * (kinds[own] + 1)))
            last = symbol(w, e)
        out.append((i, round(score + step(int(g[last]), 0), 4)))
    return out, gain


@pytest.mark.parametrize("lookup", [30, 1 << 18])
def test_scores_against_brute_force(spark, monkeypatch, lookup):
    monkeypatch.setattr(m, "LOOKUP", lookup)
    rows = [r for r in data() if len(r[1] or "") < 10_000]
    want, gain = brute_scores(rows)
    got = m.score_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    have = sorted(((str(r["doc"]), r["score"]) for r in got), key=lambda x: (x[0], round(x[1], 2)))
    want = sorted(((str(i), x) for i, x in want), key=lambda x: (x[0], round(x[1], 2)))
    assert [x[0] for x in have] == [x[0] for x in want]
    assert max(abs(a[1] - b[1]) for a, b in zip(have, want)) < 2e-3
    assert gain[-1] > gain[0]  # the exchange over the vocabulary raises the likelihood


def test_probabilities_sum_to_one():
    rnd = np.random.default_rng(3)
    pairs = rnd.poisson(4.0, (m.CLASSES, m.CLASSES)).astype(float)
    kinds = rnd.integers(0, 9, m.CLASSES).astype(float)
    step, share = m.class_model(pairs, kinds)
    assert np.allclose((10**step).sum(axis=1), 1)
    size = pairs.sum(axis=0)
    for k in range(m.CLASSES):  # the words of a class, however its count is dealt among them, and one unseen word
        c = rnd.multinomial(int(size[k]), np.ones(int(kinds[k])) / kinds[k]) if kinds[k] else np.zeros(0)
        if kinds[k]:
            assert ((c + 0.5) / share[k]).sum() + 0.5 / share[k] == pytest.approx(1)


def test_the_most_frequent_words_are_never_none(spark):
    words = spark.range(5000).selectExpr("id as word", "if(id < 10, 100L + id, 7L) as c")
    for limit in (8, 10, 200, 4000, 9000):
        got = m.most_frequent(words, limit)
        assert 0 < got.num_rows <= limit and got.column("c").to_pylist() == sorted(got.column("c").to_pylist(), reverse=True)
        assert limit < 10 or got.column("c").to_pylist()[:10] == list(range(109, 99, -1))


def test_scores_do_not_depend_on_the_lookup(spark, monkeypatch):
    df = spark.createDataFrame([(i, t, 1, "w", 1, "d") for i, t in data()], SCHEMA).repartition(3)
    monkeypatch.setattr(m, "HEAD", 20)  # on the driver: the same few symbols either way
    found = []
    for lookup in (60, 1 << 18):
        monkeypatch.setattr(m, "LOOKUP", lookup)
        found.append(sorted((str(r["doc"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6), round(r["score"], 6)) for r in m.score_documents(df).collect()))
    assert found[0] == found[1]


def test_exchange_raises_the_likelihood():
    rnd = np.random.default_rng(4)
    true = rnd.integers(0, 3, 30)
    counts = rnd.poisson(np.where((true[:, None] + 1) % 3 == true[None, :], 20.0, 0.5)).astype(float)
    before = likelihood(counts, np.append(1 + np.arange(29) % 4, 0))
    label = m.exchange(counts, classes=5, rounds=6)
    assert label[-1] == 0 and (label[:-1] > 0).all() and likelihood(counts, label) > before
    # One more round from any single change does not find a better class for that word.
    best = likelihood(counts, label)
    for w in range(29):
        for k in range(1, 5):
            other = label.copy()
            other[w] = k
            assert likelihood(counts, other) <= best + 1e-6


def test_empty_and_untrained(spark):
    assert m.score_documents(spark.createDataFrame([], SCHEMA)).collect() == []
    only = next(i for i in range(100) if m.held_out(i))
    got = m.score_documents(spark.createDataFrame([(only, "a b", 1, "", 1, "")], SCHEMA)).collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got] == [(3, 0, 0, 0.0)] and got[0]["score"] < 0


def test_hashes(monkeypatch):
    import loomlog.llm.hashing as h

    raw = np.frombuffer(b"one two one twoone " + b"z" * 100, np.uint8)
    starts, ends = np.array([0, 4, 8, 12, 19]), np.array([3, 7, 11, 18, 119])
    whole = range_hashes(raw, starts, ends)
    assert whole[0] == whole[2] and len(set(whole.tolist())) == 4
    monkeypatch.setattr(h, "LONG", 8)
    short = range_hashes(raw, starts, ends)
    assert (short[:4] == whole[:4]).all() and short[4] != whole[4]
    # Words that polynomials modulo 2^64 can't tell apart, and all words of few letters.
    for n in (6, 7, 10, 11, 12):
        word = [0]
        for _ in range(n):
            word += [1 - x for x in word]
        both = np.array([*word, 9, *(1 - x for x in word)], np.uint8) + 97
        for limit in (8, 128, 1 << 20):
            monkeypatch.setattr(h, "LONG", limit)
            got = range_hashes(both, np.array([0, len(word) + 1]), np.array([len(word), len(both)]))
            assert got[0] != got[1]
    words = sorted({bytes(rnd.choice(b"ab\0") for _ in range(rnd.randint(1, 20))) for rnd in [random.Random(5)] for _ in range(20_000)})
    ends = np.cumsum([len(w) for w in words])
    assert len(set(range_hashes(np.frombuffer(b"".join(words), np.uint8), np.append(0, ends[:-1]), ends).tolist())) == len(words)
    got, at = shingle_hashes(np.array([1, 2, 3, 1, 2, 3, 9, 1, 2], np.uint64), np.array([0, 3, 3, 6, 7, 9]), 3)
    assert at.tolist() == [0, 1, 1, 2, 3, 4] and got[0] == got[1] and len(set(got.tolist())) == 3
