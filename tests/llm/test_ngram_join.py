import random
import re

import numpy as np
import pyarrow as pa
import pytest

from loomlog.llm import ngram_join as m
from loomlog.llm.components import components

SCHEMA = "doc_id long, text string, n int, class string, label int, doc string, root int, component string"


def shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset([tuple(words)] if len(words) < size else [tuple(words[i : i + size]) for i in range(len(words) - size + 1)])


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def corpus(seed, n):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["The", "the", "é"]
    passage = " ".join(rnd.choice(vocab) for _ in range(60))
    base = [rnd.choice(vocab) for _ in range(150)]
    out = []
    for _ in range(n):
        kind = rnd.random()
        if kind < 0.35:  # a large group of near copies, some near the threshold
            words = list(base)
            for _ in range(rnd.randint(0, 9)):
                words[rnd.randrange(len(words))] = rnd.choice(vocab)
            words = words[: rnd.choice([150, 150, 140, 120, 100])]
        elif kind < 0.5:
            words = [rnd.choice(vocab) for _ in range(rnd.randint(5, 40))] + passage.split()
        elif kind < 0.6:
            words = [rnd.choice(vocab[:3]) for _ in range(rnd.randint(1, 7))]
        else:
            words = [rnd.choice(vocab) for _ in range(rnd.randint(0, 80))]
            if out and kind > 0.8:
                words = (out[-1] or "").split() + words[: rnd.randint(0, 30)]
        out.append(rnd.choice([" ", " ", "\n", "  "]).join(words))
    return [*out, None, "", " \n", out[0].upper(), "a b c d", "A B c d", "x " * 30_000]


@pytest.mark.parametrize(("seed", "bits"), [(1, 20), (2, 8), (3, 4)])
def test_against_brute_force(spark, monkeypatch, seed, bits):
    # The fewer slots a sketch has, the more lists count as heavy and are dealt out in parts.
    monkeypatch.setattr(m, "SKETCH_BITS", bits)
    monkeypatch.setattr(m, "BLOCK", 20)
    monkeypatch.setattr(m, "FREQUENT", 2)
    rows = [(i if i % 45 else None, t) for i, t in enumerate(corpus(seed, 350))]
    rows += rows[:3]
    df = spark.createDataFrame([(i, t, 1, "c", 1, "d", 1, "c") for i, t in rows], SCHEMA).repartition(5)
    got = m.jaccard_components(df).select("doc", "n_shingles", "component").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_sets_of_one_number_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(m, "class_of", lambda own: len(own) % 7 + 1 if len(own) else 0)
    monkeypatch.setattr(m, "renumbered", lambda own, number, again, shared: again.get((number, m.check_of(own)), number) if number in shared else number)
    rows = list(enumerate(corpus(5, 150)))
    rows_ = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    # Workers load the module afresh, so the weak number is made in the plan's own functions.
    scanned = spark.createDataFrame([(i, i, len(o), m.class_of(o), m.check_of(o)) for i, t in rows for _, o in m.shingle_sets(np.frombuffer((t or "").encode(), np.uint8), np.array([0, len((t or "").encode())]), 5)], "doc long, mark long, n long, class long, check long")
    classes = scanned.where("n > 0").groupBy("class").agg({"check": "min"}).withColumnRenamed("min(check)", "low").join(scanned.groupBy("class").agg({"check": "max"}).withColumnRenamed("max(check)", "high"), "class")
    apart, again = m._numbered_apart(scanned, classes)
    by = {}
    for r in apart.where("n > 0").collect():
        by.setdefault(r["class"], set()).add(r["check"])
    assert again and all(len(v) == 1 for v in by.values()) and len(by) == len({c for v in by.values() for c in v})
    twice = {c for c, _ in again}
    for _, t in rows:
        for _, o in m.shingle_sets(np.frombuffer((t or "").encode(), np.uint8), np.array([0, len((t or "").encode())]), 5):
            assert not len(o) or m.check_of(o) in by[m.renumbered(o, m.class_of(o), again, twice)]
    assert rows_.count() == len(rows)


def test_long_words_that_look_alike(spark):
    word = "a"
    for _ in range(11):
        word += word.translate(str.maketrans("ab", "ba"))
    rows = [(1, f"x y {word} z w"), (2, f"x y {word.translate(str.maketrans('ab', 'ba'))} z w")]
    got = m.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc"], r["component"]) for r in got) == [(1, 1), (2, 2)]


def test_shared_passages_below_the_threshold_leave_no_pairs(spark, monkeypatch):
    """Own words and a footer that all share: no links, and no posting of the footer's lists is left."""
    monkeypatch.setattr(m, "FREQUENT", 2)
    rnd = random.Random(4)
    footer = " ".join(f"f{i}" for i in range(80))
    rows = [(i, " ".join(f"w{rnd.randrange(10**9)}" for _ in range(24)) + " " + footer) for i in range(400)]
    rows += [(1000 + i, " ".join(f"v{rnd.randrange(10**9)}" for _ in range(6)) + " " + footer) for i in range(4)]  # linked
    seen = []
    kept = m._roomy
    monkeypatch.setattr(m, "_roomy", lambda lists: seen.append(kept(lists)) or seen[-1])
    got = m.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sorted((r["doc"], r["component"]) for r in got) == [(i, min(i, 1000)) for i, _ in rows]
    assert {r["n"] for r in seen[0].select("n").distinct().collect()} <= {82}


def test_postings_of_heavy_lists_keep_every_pair(spark, monkeypatch):
    monkeypatch.setattr(m, "HEAVY_RANK", 0)
    rnd = random.Random(7)
    rows = []
    for i in range(300):
        n = rnd.choice([5, 20, 60, 70, 100, 130, 400])
        rows.append((rnd.randint(0, 12), i, n, rnd.randint(0, n - -(-3 * n // 4)), i, rnd.randint(0, 3)))
    kept = {(r["key"], r["class"]) for r in m._roomy(spark.createDataFrame(rows, "key long, class long, n int, at int, label long, salt long")).collect()}
    for k, a, n, at, *_ in rows:
        for l, b, o, bt, *_ in rows:
            if k == l and a != b and 4 * min(n, o) >= 3 * max(n, o) and 7 * min(n - at, o - bt) >= 3 * (n + o):
                assert (k, a) in kept and (l, b) in kept


@pytest.mark.parametrize("room", [0, 8])
def test_without_broadcasts_and_with_full_filters(spark, monkeypatch, room):
    """Beyond every bound the result is the same: narrow joins by shuffles, a filter that lets strangers pass."""
    from loomlog.llm import membership

    monkeypatch.setattr(m, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(membership, "BITS", room / 8)
    rows = [(i if i % 45 else None, t) for i, t in enumerate(corpus(9, 250))]
    got = m.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).select("doc", "n_shingles", "component").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_empty(spark):
    assert m.jaccard_components(spark.createDataFrame([], SCHEMA)).collect() == []
    got = m.jaccard_components(spark.createDataFrame([(3, None, 1, "", 1, "", 1, ""), (1, "a", 1, "", 1, "", 1, "")], SCHEMA)).collect()
    assert sorted((r["doc"], r["n_shingles"], r["component"]) for r in got) == [(1, 1, 1), (3, 0, 3)]


def test_divide_skip():
    rnd = np.random.default_rng(6)
    for _ in range(60):
        sets = [np.unique(rnd.integers(0, 60, rnd.integers(1, 70)).astype(np.uint64)) for _ in range(30)]
        query = np.unique(rnd.integers(0, 60, rnd.integers(1, 90)).astype(np.uint64))
        want = [i for i, s in enumerate(sets) if 100 * len(np.intersect1d(s, query)) >= 75 * len(np.union1d(s, query))]
        assert sorted(m.DivideSkip(sets).search(query)) == want


def test_useful_postings_keep_every_pair():
    rnd = np.random.default_rng(8)
    for _ in range(300):
        key = np.sort(rnd.integers(0, 12, 40))
        n = rnd.integers(1, 40, 40)
        at = (rnd.random(40) * (n - -(-3 * n // 4) + 1)).astype(np.int64)
        keep = m.useful(key, n, at)
        for i in range(40):
            for j in range(40):
                if i != j and key[i] == key[j] and 7 * min(n[i] - at[i], n[j] - at[j]) >= 3 * (n[i] + n[j]):
                    assert keep[i] and keep[j]
        inner = (key > key[0]) & (key < key[-1])
        assert all((keep & (key == k)).sum() != 1 for k in set(key[inner].tolist()))


def test_heavy_lists_stay_whole():
    key = np.sort(np.array([m.HEAVY_RANK << 56 | i // 3 for i in range(30)], np.uint64)).view(np.int64)
    batch = pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.arange(30)), pa.array(np.full(30, 9, np.int32)), pa.array(np.full(30, 2, np.int32))], names=["key", "class", "n", "at"])
    for cuts in ([0, 30], [0, 1, 2, 13, 30], list(range(31))):
        parts = [batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:])]
        got = [x for part in m._lists(iter(parts)) for x in part.column(1).to_pylist()]
        assert got == list(range(30))
    alone = [batch.slice(i, 1) for i in (0, 5, 9)]
    assert sum(p.num_rows for p in m._lists(iter(alone))) == 3


def test_lists_across_batches(monkeypatch):
    monkeypatch.setattr(m, "useful", lambda key, n, at: np.ones(len(key), bool))
    rnd = random.Random(9)
    for _ in range(200):
        rows = sorted((rnd.randint(0, 6), rnd.randint(0, 4)) for _ in range(rnd.randint(0, 25)))
        batches, i = [], 0
        while i < len(rows):
            j = min(len(rows), i + rnd.randint(1, 5))
            part = rows[i:j]
            batches.append(pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], type=pa.int64()), pa.array([r[1] for r in part], type=pa.int64()), pa.array([1] * len(part), type=pa.int32()), pa.array([0] * len(part), type=pa.int32())], names=["key", "class", "n", "at"]))
            i = j
        got = [(a, b) for batch in m._lists(iter(batches)) for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        kinds = {}
        for a, b in set(rows):
            kinds.setdefault(a, []).append(b)
        assert got == sorted((a, b) for a, bs in kinds.items() if len(bs) > 1 for b in bs), rows


@pytest.mark.parametrize("small", [0, 500_000])
def test_components(spark, monkeypatch, small):
    monkeypatch.setattr("loomlog.llm.components.SMALL_EDGES", small)
    rnd = random.Random(3)
    edges = [(rnd.randint(0, 120), rnd.randint(0, 120)) for _ in range(90)] + [(i, i + 1) for i in range(200, 260)] + [(5, 5), (1, 2), (2, 1)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    touched = {x for e in edges if e[0] != e[1] for x in e}
    got = {(r["node"], r["root"]) for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {(x, find(x)) for x in touched}


def test_a_block_hands_on_connecting_links_only():
    """Ten pivots and ten records that are all alike: fewer links than sets, and all in one component."""
    own = np.arange(40, dtype=np.uint64)
    rows = [(1, 0, asked, 10 * asked + i, np.delete(own, i).tobytes()) for asked in (False, True) for i in range(10)]
    kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary())
    batch = pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], type=t) for k, t in enumerate(kinds)], names=["list", "salt", "asked", "own", "shingles"])
    links = [x for found in m._search(iter([batch])) for x in zip(*(c.to_pylist() for c in found.columns))]
    reached = {0}
    for _ in links:
        reached |= {x for link in links if reached & set(link) for x in link}
    assert reached == set(range(20)) and len(links) == 19
