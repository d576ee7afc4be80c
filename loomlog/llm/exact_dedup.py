"""Exact deduplication with a log-structured merge index over text digests.

1. Every scan task fills a *memtable* (digest -> smallest identifier, row count, members, text). A hit inside
   the memtable is verified byte by byte. A full memtable is flushed as a run sorted by digest.
2. Runs are dealt out by digest. Each task keeps a small LSM tree: arriving batches form a memtable, a flushed
   run has a Bloom filter, and compaction merges runs, keeping the smallest identifier and adding the counts.
3. Digests found in several runs are hits: the texts of their representatives (one row per memtable, never one
   per copy) are read again and compared byte by byte. Should a digest ever collide, its texts become variants. The
   representatives are recognised by a filter of bounded size, so no other text is moved.

Hot groups: a group with a third of all rows is one entry per memtable after step 1; representatives and member lists
are routed by (digest, salt) so no task receives a whole group. Memory is bounded by the memtable's limits and the size of a
shuffle partition. The lineage is cut by reliable checkpoints of the (narrow) runs.

Defined results: null text equals empty text; a null identifier never wins against another one; of repeated rows
(same identifier, same text) exactly one is kept; a text larger than a memtable is a memtable by itself; an empty table
gives no rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlog.llm.common import BROADCAST_ROWS, durable, lowered, pick, prepare, tidy, utf8
from loomlog.llm.membership import Members, key, may_hold

#: Limits of a memtable in the scan: entries (rows) and bytes of text kept for verification.
MEMTABLE_ROWS, MEMTABLE_BYTES = 200_000, 64 << 20
#: Rows of a memtable of the index, and runs that are merged at a time.
INDEX_ROWS, FANOUT = 50_000, 8
#: Member lists of one digest go to so many tasks, and its representatives where they are more than HOT.
SALTS, HOT = 64, 256

_RUN = T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("key", T.LongType()), T.StructField("run", T.LongType()), T.StructField("n", T.LongType()), T.StructField("sha", T.BinaryType()), T.StructField("members", T.ArrayType(T.LongType())), T.StructField("marks", T.ArrayType(T.LongType()))])
_LAST = np.iinfo(np.int64).max


class Memtable:
    """digest -> entries [smallest key, members, sha-256, text]; more than one entry only where digests collide."""

    def __init__(self, digest_bytes: int, largest: bool):
        self.size, self.largest = digest_bytes, largest
        self.entries: dict[bytes, list[list]] = {}
        self.rows = self.bytes = 0

    def key(self, identifier: int | None) -> int:
        return _LAST if identifier is None else ~identifier if self.largest else identifier

    def add(self, identifier: int | None, text: bytes, mark: int = 0) -> None:
        sha = hashlib.sha256(text).digest()
        own = self.entries.setdefault(sha[: self.size], [])
        self.rows += 1
        for entry in own:
            if entry[3] == text:  # the hit is verified
                entry[1].append((identifier, mark))
                entry[0] = min(entry[0], self.key(identifier))
                return
        own.append([self.key(identifier), [(identifier, mark)], sha, text])
        self.bytes += len(text)

    def full(self) -> bool:
        return self.rows >= MEMTABLE_ROWS or self.bytes >= MEMTABLE_BYTES

    def flush(self, run: int) -> pa.RecordBatch:
        """The sorted run; of colliding texts each has its own row."""
        rows = [(d, e[0], run + i, len(e[1]), e[2], *zip(*sorted(e[1], key=lambda m: (self.key(m[0]), m[1])))) for d in sorted(self.entries) for i, e in enumerate(self.entries[d])]
        self.entries, self.rows, self.bytes = {}, 0, 0
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], type=k) for i, k in enumerate(kinds)], names=_RUN.names)


class BloomFilter:
    """About 10 bits per digest, 4 probes taken from the digest's own words."""

    def __init__(self, words: np.ndarray):
        self.bits = max(64, 1 << int(np.ceil(np.log2(max(1, len(words)) * 10))))
        self.table = np.zeros(self.bits // 8, dtype=np.uint8)
        for at in self._probes(words):
            np.bitwise_or.at(self.table, at >> 3, (1 << (at & 7)).astype(np.uint8))

    def _probes(self, words: np.ndarray) -> Iterator[np.ndarray]:
        mask = np.uint64(self.bits - 1)
        for shift in (0, 21, 42):
            yield ((words[:, 0] >> np.uint64(shift)) & mask).astype(np.int64)
        yield (words[:, 1] & mask).astype(np.int64)

    def may_hold(self, words: np.ndarray) -> np.ndarray:
        out = np.ones(len(words), dtype=bool)
        for at in self._probes(words):
            out &= (self.table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return out


class Run:
    """Digests in ascending order with smallest (key, run), rows and number of entries."""

    def __init__(self, words: np.ndarray, values: np.ndarray):
        order = np.lexsort((values[:, 1], values[:, 0], *words.T[::-1]))
        words, values = words[order], values[order]
        first = np.ones(len(words), dtype=bool)
        first[1:] = (words[1:] != words[:-1]).any(axis=1)
        at = np.flatnonzero(first)
        self.words = words[at]
        self.values = values[at]  # sorted by (key, run): the first is the smallest
        if len(at):
            self.values = np.column_stack([self.values[:, :2], np.add.reduceat(values[:, 2], at), np.add.reduceat(values[:, 3], at)])
        self.filter = BloomFilter(self.words)


class LsmIndex:
    """An LSM tree: runs by level; a level with FANOUT runs is compacted into the next one."""

    def __init__(self) -> None:
        self.levels: list[list[Run]] = []
        self.words: list[np.ndarray] = []
        self.values: list[np.ndarray] = []
        self.rows = 0

    def add(self, words: np.ndarray, values: np.ndarray) -> None:
        self.words.append(words)
        self.values.append(values)
        self.rows += len(words)
        if self.rows >= INDEX_ROWS:
            self.flush()

    def flush(self) -> None:
        if self.rows:
            run = Run(np.concatenate(self.words), np.concatenate(self.values))
            self.words, self.values, self.rows = [], [], 0
            self._put(0, run)

    def _put(self, level: int, run: Run) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= FANOUT:
            merged = self.compact(self.levels[level])
            self.levels[level] = []
            self._put(level + 1, merged)

    @staticmethod
    def compact(runs: list[Run]) -> Run:
        return runs[0] if len(runs) == 1 else Run(np.concatenate([r.words for r in runs]), np.concatenate([r.values for r in runs]))

    def final(self) -> Iterator[Run]:
        """Runs without a common digest: what the filters rule out of all other runs needs no merging."""
        self.flush()
        runs = [r for level in self.levels for r in level]
        if len(runs) <= 1:
            yield from runs
            return
        words, values = [], []
        for i, run in enumerate(runs):
            shared = np.zeros(len(run.words), dtype=bool)
            for j, other in enumerate(runs):
                if i != j:
                    shared |= other.filter.may_hold(run.words)
            words.append(run.words[shared])
            values.append(run.values[shared])
            if not shared.all():
                yield Run(run.words[~shared], run.values[~shared])
        yield Run(np.concatenate(words), np.concatenate(values))


def _as_words(digests: pa.Array) -> np.ndarray:
    raw = b"".join(d.ljust(32, b"\0") for d in digests.to_pylist())
    return np.frombuffer(raw, dtype=">u8").reshape(-1, 4).astype(np.uint64)


def _build(digest_bytes: int, largest: bool):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, run = Memtable(digest_bytes, largest), TaskContext.get().partitionId() << 36
        for batch in batches:
            raw, at = utf8(batch.column(1))
            data, at = lowered(raw).tobytes(), at.tolist()
            for identifier, mark, a, b in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), at, at[1:]):
                table.add(identifier, data[a:b], mark)
                if table.full():
                    yield table.flush(run)
                    run += 1 << 16
        if table.rows:
            yield table.flush(run)

    return build


def _compact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index = LsmIndex()
    size = 32
    for batch in batches:
        if batch.num_rows:
            size = len(batch.column(0)[0].as_py())
            index.add(_as_words(batch.column(0)), np.column_stack([batch.column(i).to_numpy() for i in (1, 2, 3)] + [np.ones(batch.num_rows, np.int64)]))
    for run in index.final():
        for a in range(0, len(run.words), 50_000):
            raw, v = run.words[a : a + 50_000].astype(">u8").tobytes(), run.values[a : a + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([raw[i * 32 : i * 32 + size] for i in range(len(v))], type=pa.binary()), *(pa.array(v[:, i], type=pa.int64()) for i in range(4))], names=["digest", "key", "run", "total", "entries"])


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (digest, salt, run, text) sorted by digest and salt -> the different normalised texts of each, with their runs."""
    here, texts = None, {}

    def out() -> pa.RecordBatch:
        rows = list(texts.items())
        kinds = (pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.binary())
        values = ([here[0]] * len(rows) if here else [], [min(r) for _, r in rows], [r for _, r in rows], [t for t, _ in rows])
        return pa.RecordBatch.from_arrays([pa.array(v, type=k) for v, k in zip(values, kinds)], names=["digest", "first", "runs", "text"])

    for batch in batches:
        raw, at = utf8(batch.column(3))
        data, at = lowered(raw).tobytes(), at.tolist()
        for digest, salt, run, a, b in zip(*(batch.column(i).to_pylist() for i in range(3)), at, at[1:]):
            text = data[a:b]
            if (digest, salt) != here:
                if here:
                    yield out()
                here, texts = (digest, salt), {}
            texts.setdefault(text, []).append(run)
    if here:
        yield out()


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Different texts by salt, sorted by digest and first run -> runs whose text isn't the digest's first one, as variants."""
    digest, texts = None, []
    for batch in batches:
        out = []
        for d, _, runs, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if d != digest:
                digest, texts = d, []
            if text not in texts:
                texts.append(text)
            if variant := texts.index(text):
                out += [(d, run, variant) for run in runs]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], type=k) for i, k in enumerate((pa.binary(), pa.int64(), pa.int64()))], names=["digest", "run", "variant"])


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both in one worker, where a digest's rows are together."""
    return _compare(_distinct(batches))


def _index(runs: DataFrame) -> DataFrame:
    return runs.select("digest", "key", "run", "n").repartition("digest").mapInArrow(tidy(_compact), "digest binary, key long, run long, total long, entries long")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", digest_bytes: int = 32) -> DataFrame:
    """One row per input row: doc, mark (xxhash64 of the text), keep, group_size, kept, sha (of the text after lower-casing A-Z).

    ``digest_bytes`` shortens the index key; results stay exact, as hits are verified byte by byte.
    """
    prepare(docs.sparkSession)
    largest = {"smallest": False, "largest": True}[keep]
    rows = pick(docs, doc=f"{id_col} long", text=f"{text_col} string").withColumn("mark", F.xxhash64("text"))
    runs = durable(rows.mapInArrow(tidy(_build(digest_bytes, largest)), _RUN))
    index = durable(_index(runs))

    # Byte verification of hits between runs; each entry is represented by its smallest identifier.
    back = F.bitwise_not("key") if largest else F.col("key")
    hits = runs.join(index.where("entries > 1").select("digest", (F.col("entries") > HOT).alias("hot")), "digest")
    hits = durable(hits.select("run", "hot", F.when(F.col("key") != _LAST, back).alias("doc"), F.col("sha").alias("own")))
    if n := hits.count():
        # A filter of the hits' identifiers and texts finds their rows; the join tells which run each belongs to.
        sha = F.unhex(F.sha2(F.coalesce(_lower("text"), F.lit("")), 256))
        some = may_hold(rows, Members(hits.select(key("doc").alias("k")).select("k.a", "k.b"), n), "doc").withColumn("sha", sha)
        hits = hits.withColumnRenamed("doc", "of")
        near = F.broadcast(hits) if n <= BROADCAST_ROWS else hits
        salt = F.when(F.col("hot"), F.pmod(F.shiftright("run", 36), F.lit(SALTS))).otherwise(F.lit(0).cast("long"))
        texts = some.join(near, (F.col("sha") == F.col("own")) & F.col("doc").eqNullSafe(F.col("of"))).select(F.substring("own", 1, digest_bytes).alias("digest"), salt.alias("salt"), "run", "text", "hot")
        found = lambda rows: rows.select("digest", "salt", "run", "text").repartition("digest", "salt").sortWithinPartitions("digest", "salt", "run")
        variant_of = "digest binary, run long, variant long"
        # All of a digest's texts meet at once; those of a hot one by salt, and then the different ones of each salt.
        variants = found(texts.where("not hot")).mapInArrow(tidy(_variants), variant_of)
        if not hits.where("hot").isEmpty():
            hot = found(texts.where("hot")).mapInArrow(tidy(_distinct), "digest binary, first long, runs array<long>, text binary")
            variants = variants.unionByName(hot.repartition("digest").sortWithinPartitions("digest", "first").mapInArrow(tidy(_compare), variant_of))
        variants = durable(variants.distinct())
        if not variants.isEmpty():
            variant = F.coalesce(F.col("variant"), F.lit(0)).cast("string").cast("binary")
            runs = runs.join(variants, ["digest", "run"], "left").withColumn("digest", F.unhex(F.sha2(F.concat("digest", variant), 256))).drop("variant")
            runs, index = (runs := durable(runs)), durable(_index(runs))

    salted = runs.withColumn("salt", F.pmod(F.shiftright("run", 16) + F.shiftright("run", 36), F.lit(SALTS)))
    wanted = salted.groupBy("digest", "salt").agg(F.lit(1).alias("one")).join(index, "digest").select("digest", "salt", F.col("key").alias("best"), F.col("run").alias("best_run"), "total")
    found = salted.join(wanted, ["digest", "salt"])
    each = found.select("*", F.posexplode(F.arrays_zip("members", "marks")).alias("pos", "m"))
    win = (F.col("pos") == 0) & (F.col("run") == F.col("best_run"))
    keep_id = F.when(F.col("best") != _LAST, F.bitwise_not("best") if largest else F.col("best"))
    return each.select(F.col("m.members").alias("doc"), F.col("m.marks").alias("mark"), keep_id.alias("keep"), F.col("total").alias("group_size"), win.alias("kept"), F.lower(F.hex("sha")).alias("sha"))


def _lower(column: str):
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(column, upper, upper.lower())
