import random
import re
from fractions import Fraction

import numpy as np
import pytest

from loomlog.llm import mixing

SCHEMA = "doc_id long, text string, source string, size int, target string, doc string"


def slow_sainte_lague(votes, seats, caps):
    out = [0] * len(votes)
    for _ in range(seats):
        best = max((i for i in range(len(votes)) if votes[i] and out[i] < caps[i]), key=lambda i: (Fraction(votes[i]) / (2 * out[i] + 1), -i), default=None)
        if best is None:
            break
        out[best] += 1
    return out


def test_sainte_lague_is_highest_quotients():
    rnd = random.Random(2)
    for _ in range(200):
        votes = [rnd.choice([0, 1, 3, 3, 7, 50, rnd.randint(0, 400)]) for _ in range(rnd.randint(1, 8))]
        caps = [rnd.choice([3, 10, 1000]) for _ in votes]
        seats = rnd.randint(0, 60)
        assert mixing.sainte_lague(np.array(votes), seats, np.array(caps)).tolist() == slow_sainte_lague(votes, seats, caps)


def test_targets():
    assert mixing.targets([10, 10], [5, 2], 3) == [pytest.approx(100 / 7), pytest.approx(40 / 7)]
    assert mixing.targets([1, 100, 0], [5, 2, 1], 3) == [3.0, 98.0, 0.0]


def rows(n, seed=1):
    rnd = random.Random(seed)
    out = [(i, " ".join("w" for _ in range(rnd.randint(0, 300))), rnd.choice(["b", "a", "a", "a", "é", None, "Z"]), 1, "t", "d") for i in range(n)]
    return [*out, (None, "x y", "a", 1, "t", "d"), (n, None, "nul", 1, "t", "d"), (n + 1, "", "b", 1, "t", "d"), (n + 2, "w " * 20_000, "b", 1, "t", "d"), out[0], out[0]]


def test_mix(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_DOCS", 100)
    data = rows(1500)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    got = mixing.mix_documents(df).collect()
    assert len(got) == len(data)
    again = mixing.mix_documents(df.repartition(3)).collect()
    key = lambda r: str((r["doc"], r["size"], r["taken"], r["target"]))
    assert sorted(map(key, got)) == sorted(map(key, again))
    sizes = {}
    for _, text, source, *_ in data:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    goal = dict(zip(order, mixing.targets([sizes[s] for s in order], [(5.0, 2.0, 1.0)[i % 3] for i in range(len(order))], 3)))
    taken = dict.fromkeys(order, 0)
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"] and r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(goal[r["source"]])
        taken[r["source"]] += r["taken"]
    for s in order:
        assert abs(taken[s] - goal[s]) <= 0.01 * goal[s] + mixing.BLOCK_WORDS


def test_positions_against_brute_force():
    cells = [("a", 0, 1000), ("a", 1, 37), ("b", 0, 5000), (None, 0, 10)]
    for s, h, size, goal, words, n, passes, first, last in mixing.quotas(cells):
        run = sum((i + 1) * words // n - i * words // n for i in (j % n for j in range(first, last)))
        lo, hi, wrap = first * words // n, min(last, n) * words // n, max(last - n, 0) * words // n
        assert run == hi - lo + wrap and passes + (last > first) <= 3 and last - first < max(n, 1)


def test_empty_and_wordless(spark):
    assert mixing.mix_documents(spark.createDataFrame([], SCHEMA)).collect() == []
    got = mixing.mix_documents(spark.createDataFrame([(1, None, "a", 1, "", ""), (2, " ", None, 1, "", "")], SCHEMA)).collect()
    assert [r["taken"] for r in got] == [0, 0]


def test_render(spark):
    df = spark.createDataFrame([(1, "a b  c d", 2, 1, 3, 0, 1), (2, "x", 0, 0, 0, 0, 0)], "doc long, text string, passes long, cut1_from long, cut1_to long, cut2_from long, cut2_to long")
    assert sorted(map(tuple, df.mapInArrow(mixing.render, "doc long, text string").collect())) == [(1, "a\nb  c"), (1, "a b  c d"), (1, "a b  c d")]
