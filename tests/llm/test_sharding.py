import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from loomlog.llm import sharding

SCHEMA = "doc_id long, text string, shard int, slot int, anchor string, label string, doc string"


def check(got, rows, shards):
    assert sorted(((r["doc"], r["size"], r["text_crc32"]) for r in got), key=str) == sorted(((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows), key=str)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    sizes = [len(slots[s]) for s in range(shards)]
    assert set(slots) <= set(range(shards)) and max(sizes) - min(sizes) <= 1
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 1, 2, "a", "l", "d") for d, t in rows], SCHEMA)


@pytest.mark.parametrize("n", [0, 3, 2000])
def test_rows_are_even_and_groups_stay_together(spark, monkeypatch, n):
    monkeypatch.setattr(sharding, "ANCHOR_ROWS", 100)
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 10)
    rnd = random.Random(n)
    rows = [(i, "hot" if rnd.random() < 0.33 else f"pair {i // 2}" if rnd.random() < 0.6 else f"own é {i}") for i in range(n)]
    if n > 100:
        rows += [(None, "x"), (None, None), (n, ""), (n + 1, "y" * 200_000), rows[0], rows[0]]
    got = sharding.balanced_shards(frame(spark, rows).repartition(4), 16).collect()
    check(got, rows, 16)
    again = sharding.balanced_shards(frame(spark, rows).repartition(3), 16).collect()
    key = lambda r: str((r["doc"], r["text_crc32"], r["shard"], r["slot"]))
    assert sorted(map(key, got)) == sorted(map(key, again))
    if n > 100:
        groups = defaultdict(Counter)
        for r in got:
            groups[r["text_crc32"]][r["shard"]] += 1
        pairs = [g for g in groups.values() if sum(g.values()) == 2]
        assert len(pairs) > 50 and sum(len(g) == 1 for g in pairs) > 0.85 * len(pairs)


@pytest.mark.parametrize("dealt", [1 << 14, 4])
def test_only_groups_larger_than_a_quota_are_cut(spark, monkeypatch, dealt):
    monkeypatch.setattr(sharding, "DEALT", dealt)
    sizes = {"giant": 5000, **{f"group {n}": n for n in (600, 900, 1200, 1500, 1800, 2100)}, **{f"few {i}": 2 + i % 5 for i in range(300)}}
    rows = [(None, t) if i % 50 == 1 else (len(t) * 10_000 + i, t) for t, n in sizes.items() for i in range(n)]
    rows += [(10**9 + i, f"own {i}") for i in range(40_000 - len(rows))]
    got = sharding.balanced_shards(frame(spark, rows).repartition(4), 16).collect()
    check(got, rows, 16)
    groups = defaultdict(Counter)
    for r in got:
        groups[r["text_crc32"]][r["shard"]] += 1
    of = {t: groups[zlib.crc32(t.encode())] for t in sizes}
    assert len(of.pop("giant")) == 2 and all(len(g) == 1 for g in of.values())


def test_groups_alone_fill_even_shards(spark, monkeypatch):
    monkeypatch.setattr(sharding, "DEALT", 4)
    rows = [(i, f"group {i // 3}") for i in range(2000)]
    got = sharding.balanced_shards(frame(spark, rows).repartition(4), 16).collect()
    check(got, rows, 16)
    groups = defaultdict(set)
    for r in got:
        groups[r["text_crc32"]].add(r["shard"])
    assert sum(len(g) > 1 for g in groups.values()) <= 15


def test_quota():
    wishes = np.array([[0, 10, 0], [4, 0, 8], [0, 0, 0]])
    share = sharding.quota(wishes, np.array([10.0, 10.0, 6.0]), 10.0)
    assert share[0, 1] == pytest.approx(0.4) and share[1, 0] == 1 and share[1, 2] == pytest.approx(0.5)
