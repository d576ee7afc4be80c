import hashlib
import random

import pytest

from loomlog.llm import exact_dedup as m
from loomlog.llm.exact_dedup import exact_duplicates

SCHEMA = "doc_id long, text string, run int, sha string, digest string"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, keep):
    groups = {}
    for doc, text, *_ in rows:
        groups.setdefault(lower(text), []).append(doc)
    out = []
    for text, docs in groups.items():
        known = [d for d in docs if d is not None]
        best = (max if keep == "largest" else min)(known) if known else None
        kept = True
        for d in sorted(docs, key=lambda d: d != best):
            out.append((d, best, len(docs), kept, hashlib.sha256(text.encode()).hexdigest()))
            kept = False
    return out


def rows_of(df):
    return sorted(map(tuple, df.select("doc", "keep", "group_size", "kept", "sha").collect()), key=str)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("digest_bytes", [1, 32])
def test_against_brute_force(spark, keep, digest_bytes):
    rnd = random.Random(7)
    pool = ["", None, "A b", "a B", "é", "É", "x" * 300_000, "\n", *(f"Text {i}" for i in range(300))]
    rows = [(i if rnd.random() < 0.97 else None, pool[0] if rnd.random() < 0.3 else rnd.choice(pool), 1, "s", "d") for i in range(2000)]
    rows += rows[:5]  # repeated rows
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert rows_of(exact_duplicates(df, keep=keep, digest_bytes=digest_bytes)) == sorted(brute(rows, keep), key=str)


def test_empty_table(spark):
    assert exact_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_memtable_flushes(spark, monkeypatch):
    from loomlog.llm import exact_dedup as m

    table = m.Memtable(2, False)
    for i in range(50):
        table.add(i, b"t%d" % (i % 20))
    run = table.flush(5 << 36)
    assert run.num_rows == 20 and run.column(0).to_pylist() == sorted(run.column(0).to_pylist()) and not table.entries
    monkeypatch.setattr(m, "INDEX_ROWS", 3)
    monkeypatch.setattr(m, "FANOUT", 2)
    index = m.LsmIndex()
    import numpy as np

    rnd = np.random.default_rng(3)
    seen = {}
    for i in range(200):
        d, k = int(rnd.integers(0, 40)), int(rnd.integers(0, 1000))
        index.add(np.array([[d, 1, 2, d]], np.uint64), np.array([[k, i, 2, 1]], np.int64))
        old = seen.get(d, (k, i, 0, 0))
        seen[d] = (*min(old[:2], (k, i)), old[2] + 2, old[3] + 1)
    found = {int(w[0]): tuple(map(int, v)) for run in index.final() for w, v in zip(run.words, run.values)}
    assert found == seen and sum(len(r.words) for r in index.final()) == len(seen)


@pytest.mark.parametrize("hot", [1, 256])
def test_colliding_digests_of_hot_groups(spark, monkeypatch, hot):
    """Digests of one byte, representatives dealt by salt or not: groups are those of the texts."""
    monkeypatch.setattr(m, "HOT", hot)
    monkeypatch.setattr(m, "BROADCAST_ROWS", 0 if hot == 1 else 200_000)
    rows = [(i, f"Text {i % 300}" if i % 2 else f"tEXT {i % 300}") for i in range(3000)]
    got = m.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), digest_bytes=1).collect()
    assert sorted((r["doc"], r["keep"], r["group_size"], r["kept"]) for r in got) == [(i, i % 300, 10, i < 300) for i in range(3000)]
