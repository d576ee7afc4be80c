import random

import pytest
from pyspark.sql import functions as F

from loomlog.llm import membership as m
from loomlog.llm.membership import Members, key, may_hold, without

SCHEMA = "doc_id long, mark long, text string, a long, b string"


def table(spark, n=3000):
    rnd = random.Random(8)
    rows = [(rnd.choice([None, i, i, i, rnd.randrange(n)]), rnd.choice([None, i, i, i % 7]), f"t{i}", i, "x") for i in range(n)]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(4)


def keyed(df, drop):
    return df.withColumn("k", key("doc_id", "mark")).select("k.a", "k.b", drop.alias("drop"))


# A filter with room; one so full that most strangers pass; one too full for them all to be listed; none at all.
@pytest.mark.parametrize(("bits", "listed", "size"), [(14, 4_000_000, 64 << 20), (1, 4_000_000, 64 << 20), (1, 10, 64 << 20), (14, 4_000_000, 0)])
def test_without_drops_exactly_the_dropped(spark, monkeypatch, bits, listed, size):
    for name, value in (("BITS", bits), ("LISTED", listed), ("FILTER_BYTES", size), ("SEGMENT_BYTES", 1 << 10)):
        monkeypatch.setattr(m, name, value)
    rows, df = table(spark)
    drop = F.pmod(F.xxhash64("doc_id", "mark"), F.lit(3)) == 0
    got = without(df, keyed(df, drop), "doc_id", "mark")
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, df.where(~drop).collect()), key=str) and 0 < got.count() < len(rows)


def test_plans_move_no_text(spark):
    _, df = table(spark)
    plan = without(df, keyed(df, F.col("doc_id") % 3 == 0), "doc_id", "mark")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") <= 1  # the fixture's own


def test_nothing_dropped(spark):
    _, df = table(spark, 50)
    assert without(df, keyed(df, F.lit(False)), "doc_id", "mark") is df
    assert without(df.limit(0), keyed(df.limit(0), F.lit(True)), "doc_id", "mark").count() == 0


def test_may_hold_loses_nothing(spark, monkeypatch):
    rows, df = table(spark)
    wanted = df.where("a % 10 = 0")
    for bits, size in ((14, 64 << 20), (14, 1 << 10), (0.01, 64 << 20)):
        monkeypatch.setattr(m, "BITS", bits)
        monkeypatch.setattr(m, "FILTER_BYTES", size)
        monkeypatch.setattr(m, "SEGMENT_BYTES", 1 << 10)
        keys = wanted.select(key("doc_id", "mark").alias("k")).select("k.a", "k.b").distinct()
        got = {r["a"] for r in may_hold(df, Members(keys), "doc_id", "mark").collect()}
        assert {r[3] for r in rows if r[3] % 10 == 0} <= got
        if bits == 14 and size == 64 << 20:
            assert len(got) < 0.3 * len(rows)


def test_workers_forget_what_other_tasks_kept():
    """An encoder of the packing stage must not stay in a worker that goes on to other stages."""
    import pyarrow as pa

    from loomlog.llm import common

    made = []
    make = lambda: made.append(1) or [1]
    batch = pa.RecordBatch.from_arrays([pa.array([1])], names=["x"])

    def uses(batches):
        common.kept(("own", 1), make)
        yield from batches

    for _ in range(2):
        assert list(common.tidy(uses, keeps=True)(iter([batch]))) == [batch]
    assert len(made) == 1 and common._kept
    assert list(common.tidy(iter)(iter([batch]))) == [batch]
    assert not common._kept
