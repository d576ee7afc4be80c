"""Rows that belong to a set of keys, without moving the rows: filters and exact lists, built by the executors and broadcast.

A key is any combination of columns, known by two independent 64-bit hashes. The filter of a set (Bloom, SEGMENT_BYTES a
segment, keys dealt to segments by their hash) is built segment by segment and never exceeds FILTER_BYTES: a fuller one
only lets more strangers pass.

* ``may_hold`` keeps the rows of the set and some strangers: for uses that check each row anyway, at every size.
* ``without`` drops exactly the rows of the set. The keys of all rows are known from a narrow table, so those of the
  strangers that pass are found in advance and broadcast beside the filter (16 bytes each, LISTED at most). Where there
  are more of them, or more keys than a filter holds, the rows are joined by a shuffle instead.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomlog.llm.common import durable, forget, tidy

#: Bits of a key and probes, bytes of a segment, and of all segments at most.
BITS, PROBES, SEGMENT_BYTES, FILTER_BYTES = 14, 7, 1 << 18, 64 << 20
#: Strangers that are listed beside a filter at most.
LISTED = 4_000_000


def key(*columns: str) -> Column:
    """Both hashes of a row's key; nulls are values of their own."""
    parts = [x for c in columns for x in (F.col(c), F.isnull(c))]
    return F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(1), *parts).alias("b"))


def _probes(a: np.ndarray, b: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    mask = np.uint64(bits - 1)
    for i in range(PROBES):
        yield ((a + np.uint64(i) * (b | np.uint64(1))) >> np.uint64(13)) & mask


def _segment(b: np.ndarray, segments: int) -> np.ndarray:
    return ((b >> np.uint64(32)) % np.uint64(segments)).astype(np.int64)


def _unsigned(x) -> np.ndarray:
    return np.asarray(x, dtype=np.int64).view(np.uint64)


def _build(segments: int, bits: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[int, np.ndarray] = {}
        for batch in batches:
            a, b = (_unsigned(batch.column(i).to_numpy()) for i in (0, 1))
            own = _segment(b, segments)
            for s in np.unique(own).tolist():
                table = tables.setdefault(s, np.zeros(bits // 8, np.uint8))
                mine = own == s
                for at in _probes(a[mine], b[mine], bits):
                    np.bitwise_or.at(table, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array(list(tables), type=pa.int32()), pa.array([zlib.compress(t.tobytes(), 1) for t in tables.values()], type=pa.binary())], names=["segment", "bits"])

    return build


class Members:
    """The filter of a set of keys (table with columns a, b), and how many keys there are."""

    def __init__(self, keys: DataFrame, n: int | None = None):
        spark = keys.sparkSession
        self.n = keys.count() if n is None else n
        wanted = -(-self.n * BITS // (8 * SEGMENT_BYTES))
        self.segments = max(1, min(wanted, FILTER_BYTES // SEGMENT_BYTES))
        need = max(1024, min(8 * SEGMENT_BYTES, -(-self.n * BITS // self.segments)))
        self.bits = 1 << int(np.ceil(np.log2(need)))
        segment = F.expr(f"pmod(shiftrightunsigned(b, 32), {self.segments}L)")
        parts = keys.select("a", "b").repartition(min(self.segments, 200), segment).mapInArrow(tidy(_build(self.segments, self.bits)), "segment int, bits binary")
        table = np.zeros((self.segments, self.bits // 8), np.uint8)
        for r in parts.collect():  # FILTER_BYTES at most
            table[r["segment"]] |= np.frombuffer(zlib.decompress(r["bits"]), np.uint8)
        self.shared = spark.sparkContext.broadcast(table)

    @property
    def fits(self) -> bool:
        """Whether the filter has its bits for each key, so that hardly any stranger passes."""
        return self.n * BITS <= 2 * 8 * FILTER_BYTES

    def passing(self, strangers=None):
        """A function over arrays a, b: whether the filter lets the key pass and it isn't one of the listed strangers."""
        shared, segments, bits = self.shared, self.segments, self.bits

        def passes(a: pa.Array, b: pa.Array) -> pa.Array:
            forget()
            table, x, y = shared.value, _unsigned(a.to_numpy(zero_copy_only=False)), _unsigned(b.to_numpy(zero_copy_only=False))
            own, out = _segment(y, segments), np.ones(len(x), dtype=bool)
            for at in _probes(x, y, bits):
                out &= (table[own, (at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
            if strangers is not None and len(strangers.value):
                listed = strangers.value  # sorted by a, then b
                for i in np.flatnonzero(out).tolist():
                    lo, hi = np.searchsorted(listed["a"], x[i], "left"), np.searchsorted(listed["a"], x[i], "right")
                    out[i] = not (hi > lo and (listed["b"][lo:hi] == y[i]).any())
            return pa.array(out)

        return passes

    def test(self, strangers=None):
        """The same over columns. Arrow arrays go to the workers and back, so these need no pandas."""
        return F.arrow_udf(self.passing(strangers), "boolean")

    def free(self) -> None:
        self.shared.unpersist()


def may_hold(rows: DataFrame, members: Members, *columns: str) -> DataFrame:
    """Rows whose key is in the set, and a few others."""
    return rows.withColumn("__key", key(*columns)).where(members.test()(F.col("__key.a"), F.col("__key.b"))).drop("__key")


def without(rows: DataFrame, verdicts: DataFrame, *columns: str) -> DataFrame:
    """``rows`` but those whose key is one of the dropped. verdicts: a, b and drop, a row for each row (or for each key)."""
    spark = rows.sparkSession
    dropped = durable(verdicts.where("drop").select("a", "b").distinct())
    n = dropped.count()
    if not n:
        return rows
    members = Members(dropped, n) if n * BITS <= 2 * 8 * FILTER_BYTES else None
    keyed = rows.withColumn("__key", key(*columns))
    if members is not None:
        passing = verdicts.where("not drop").where(members.test()(F.col("a"), F.col("b"))).select("a", "b").distinct()
        strangers = durable(passing.join(dropped, ["a", "b"], "left_anti"))
        if strangers.count() <= LISTED:
            found = strangers.toArrow()
            listed = np.zeros(found.num_rows, dtype=[("a", "u8"), ("b", "u8")])
            listed["a"], listed["b"] = (_unsigned(found.column(c).to_numpy()) for c in ("a", "b"))
            shared = spark.sparkContext.broadcast(np.sort(listed, order=["a", "b"]))
            return keyed.where(~members.test(shared)(F.col("__key.a"), F.col("__key.b"))).drop("__key")
    gone = dropped.select(F.col("a").alias("__a"), F.col("b").alias("__b"))
    return keyed.join(gone, (F.col("__key.a") == F.col("__a")) & (F.col("__key.b") == F.col("__b")), "left_anti").drop("__key")
