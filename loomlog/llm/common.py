"""Helpers shared by the training-data operators: column handling and numpy views of Arrow strings."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlog.session import ensure_checkpoint_dir, ship

#: The six characters that separate words (space, tab, newline, vertical tab, form feed, return).
WORD_BREAKS = " \t\n\x0b\x0c\r"

_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[list(WORD_BREAKS.encode())] = False

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


#: Bytes of an Arrow batch: what workers and executors hold beside their own structures follows from it.
BATCH_BYTES = 4 << 20


def prepare(spark: SparkSession) -> None:
    """Ship the package to the workers, bound Arrow batches by bytes and find the checkpoint folder."""
    ship(spark)
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def _release() -> None:
    """Hand free memory back, as workers live on between tasks."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


_kept: dict = {}


def kept(name: tuple, make):
    """What the worker made under this name, kept for its next tasks until one of another kind comes. A function of the
    module, as a task's closure would bring a new, empty dictionary."""
    if name not in _kept:
        _kept.clear()
        _kept[name] = make()
    return _kept[name]


def forget() -> None:
    """Lets go of what the worker kept for tasks of another kind: workers outlive their stage."""
    if _kept:
        _kept.clear()
        _release()


def tidy(run, keeps: bool = False):
    """The same function over batches, which releases free memory at the end of a task; unless it ``keeps`` something
    itself, what other functions kept goes first."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            forget()
        yield from run(batches)
        _release()

    return tidied


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, renamed and cast: other columns, whatever their names, play no part.

    ``pick(df, doc="doc_id long", text="text string")``; a column that is missing becomes nulls.
    """
    found = {c.lower(): c for c in reversed(df.columns)}
    out = []
    for name, spec in columns.items():
        source, kind = spec.split(" ")
        col = df[f"`{found[source.lower()]}`"] if source.lower() in found else F.lit(None)
        out.append(col.cast(kind).alias(name))
    return df.select(*out)


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder; it survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> tuple[DataFrame, str]:
    """The same rows as a table written in the shared folder, and its path. For loops: a checkpoint keeps the logical plan
    for its statistics, which a loop multiplies; a table cuts that too, and its size is known to the planner."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a table of the shared folder that no plan reads any more, not even to make up for a lost executor."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def swept(spark: SparkSession) -> None:
    """Lets go of the shuffle files of plans that are gone: Spark deletes them only as the driver collects garbage,
    which may take longer than the whole query."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Rows of a partition that a small intermediate table is read in.
SETTLED_ROWS = 20_000


def settled(df: DataFrame) -> tuple[DataFrame, int]:
    """A checkpoint and its number of rows; many almost empty partitions are read as few."""
    df = durable(df)
    n = df.count()
    return df.coalesce(max(1, -(-n // SETTLED_ROWS))), n


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n+1 offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def lowered(raw: np.ndarray) -> np.ndarray:
    """A-Z become a-z, every other byte stays."""
    return _LOWER[raw]


def per_row(marks: np.ndarray, at: np.ndarray, step: int = 1 << 20) -> np.ndarray:
    """How many marks each row has; the running sum is kept for a slice at a time."""
    before, done = np.zeros(len(at), np.int64), 0
    for s in range(0, len(marks), step):
        sums = np.append(0, np.cumsum(marks[s : s + step], dtype=np.int32))
        lo, hi = np.searchsorted(at, s), np.searchsorted(at, s + step)
        before[lo:hi] = done + sums[np.minimum(at[lo:hi] - s, len(sums) - 1)]
        done += int(sums[-1])
    before[np.searchsorted(at, max(len(marks), 1)) :] = done
    return np.diff(before)


def words_of(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (byte positions) of all words, and the n+1 positions of the rows among them."""
    inside = np.zeros(len(raw) + 2, dtype=bool)
    inside[1:-1] = _IS_WORD[raw]
    step = inside[1:] != inside[:-1]
    # A row boundary inside a run of word bytes ends one word and starts the next.
    edges = at[1:-1]
    edges = edges[(edges > 0) & (edges < len(raw))]
    glued = np.unique(edges[inside[edges] & inside[edges + 1]])
    marks = np.flatnonzero(step)
    starts, ends = marks[0::2], marks[1::2]
    if len(glued):
        starts = np.sort(np.concatenate([starts, glued]))
        ends = np.sort(np.concatenate([ends, glued]))
    rows = np.searchsorted(starts, at)
    return starts, ends, rows


def word_counts(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Words of each row: bytes of words that begin a row or follow a byte that isn't one."""
    inside = _IS_WORD[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = at[1:-1]
    edges = edges[edges < len(raw)]
    first[edges] = inside[edges]
    return per_row(first, at)


def salted_totals(rows: DataFrame, key: str, spread: str, measures: dict, salts: int = 64, how=F.sum) -> DataFrame:
    """Totals of ``measures`` (name -> expression, summed or as ``how`` says) per key, one row for each (key, salt) that occurs.

    ``rows`` may be joined with the result on (key, salt) without a task receiving a whole hot key. Keys may be null.
    ``spread`` is a column that differs between the rows of a key.
    """
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
    counts = salted.groupBy(key, "salt").agg(*[how(e).alias(n) for n, e in measures.items()])
    totals = counts.groupBy(key).agg(*[how(n).alias(n) for n in measures], F.collect_set("salt").alias("salts"))
    return totals.select(F.col(key).alias("total_key"), *measures, F.explode("salts").alias("total_salt"))


#: Narrow rows (16 to 40 bytes each, counted) that are broadcast at most; beyond, the same narrow tables are joined by a shuffle.
BROADCAST_ROWS = 200_000
