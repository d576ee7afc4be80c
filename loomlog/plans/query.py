"""Filters and ordered queries over message tables."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlog.sources import files
from loomlog.sources import reading as r
from loomlog.sources.errors import LogError
from loomlog.sources.tables import read_table, wanted_topics

ORDERS = ("log_time", "reverse_log_time", "file")


@dataclass(frozen=True)
class MessageFilter:
    """One topic or a set of topics, and start_time <= log_time < end_time. An empty set selects nothing."""

    topic: str | None = None
    topics: Iterable[str] | None = None
    start_time: int | None = None
    end_time: int | None = None

    def __post_init__(self):
        if self.topic is not None and self.topics is not None:
            raise ValueError("topic and topics exclude each other")
        if self.start_time is not None and self.end_time is not None and self.start_time > self.end_time:
            raise ValueError("start_time is after end_time")

    @property
    def empty(self) -> bool:
        return self == MessageFilter()

    def apply(self, messages: DataFrame) -> DataFrame:
        out = messages
        if self.topic is not None:
            out = out.where(F.col("topic") == self.topic)
        if self.topics is not None:
            wanted = list(self.topics)
            out = out.where(F.col("topic").isin(wanted) if wanted else F.lit(False))
        if self.start_time is not None:
            out = out.where(F.col("log_time") >= self.start_time)
        if self.end_time is not None:
            out = out.where(F.col("log_time") < self.end_time)
        return out

    def options(self) -> dict:
        """The same as options of the source, which prunes chunks and rows before Spark sees them."""
        return {"topic": self.topic, "topics": wanted_topics(self.topics), "startTime": self.start_time, "endTime": self.end_time}


@dataclass(frozen=True)
class Query(MessageFilter):
    """An ordered query; ties of log_time go by file order, reversed where the order is."""

    order: str = "log_time"
    access: str = "auto"
    allow_sort: bool = True
    max_sort_bytes: int | None = None

    def __post_init__(self):
        super().__post_init__()
        if self.order not in ORDERS:
            raise ValueError(f"order is one of {', '.join(ORDERS)}")


def ordered(messages: DataFrame, order: str) -> DataFrame:
    if order == "file":
        return messages.orderBy("path", "record_ordinal")
    if order == "log_time":
        return messages.orderBy("log_time", "path", "record_ordinal")
    return messages.orderBy(F.desc("log_time"), F.desc("path"), F.desc("record_ordinal"))


def indexed(path: str, start_offset: int = 0) -> bool:
    """Whether the chunk indexes of all recordings under the path cover their messages: footers, summaries and what no
    index names are read, several recordings at a time."""

    def usable(p: str) -> bool:
        with files.opened(p) as data:
            try:
                return r.index_usable(data, r.read_summary(data, start_offset, declarations=False), start_offset)
            except LogError as e:
                if e.kind == "BadIndex":
                    raise
                return False

    with ThreadPoolExecutor(16) as pool:
        return all(pool.map(usable, files.expand(path)))


def read_messages(spark: SparkSession, path: str, where: MessageFilter = MessageFilter(), **options) -> DataFrame:
    """A sequential scan; filtered rows are checked like the others. Partitions and their rows come in file order, so
    nothing is sorted; after a shuffle, (path, record_ordinal) gives the order back."""
    return where.apply(read_table(spark, path, access="scan", **where.options(), **options))


def query_messages(spark: SparkSession, path: str, query: Query = Query(), **options) -> DataFrame:
    """By index where it serves, else by scan and sort, if that is allowed."""
    if query.order != "file" and not query.allow_sort and not indexed(path):
        raise NotImplementedError("the recording has no usable index, and sorting is not allowed")
    found = query.apply(read_table(spark, path, access=query.access, **query.options(), **options))
    if query.max_sort_bytes is not None and query.order != "file" and query.access != "indexed" and not indexed(path):
        size = found.agg(F.sum(F.octet_length("data"))).first()[0] or 0
        if size > query.max_sort_bytes:
            raise LogError("Binding", "the rows to sort exceed the allowance", resource="sort", limit=query.max_sort_bytes, requested=size)
    return ordered(found, query.order)


def indexed_messages(spark: SparkSession, path: str, query: Query = Query(), **options) -> DataFrame:
    """By index only; never a scan instead."""
    if not indexed(path):
        raise LogError("Binding", "the recording has no usable chunk indexes", resource="index")
    return ordered(query.apply(read_table(spark, path, access="indexed", **query.options(), **options)), query.order)


def visited(messages: DataFrame, stop: str) -> DataFrame:
    """Messages of each recording in file order up to and with the first one for which ``stop`` (SQL) is true: a visitor
    that stops early. Where it stops is one minimum for each recording, so messages aren't sorted."""
    ends = messages.where(F.expr(stop)).groupBy("path").agg(F.min("record_ordinal").alias("__end"))
    return messages.join(ends, "path", "left").where("__end is null or record_ordinal <= __end").drop("__end")


def batches(messages: DataFrame, count: int = 256, target_bytes: int = 4 << 20) -> DataFrame:
    """Numbers each recording's batches in file order: one ends after ``count`` messages or with the message that
    reaches the soft target of payload bytes. Batches depend on all before them, so each recording is one ordered
    stream, cut by a running state."""
    import pandas as pd

    from loomlog.session import ship

    ship(messages.sparkSession)
    if count < 1 or target_bytes < 1:
        raise ValueError("count and target_bytes are positive")
    rows = messages.select("path", "record_ordinal", F.coalesce(F.octet_length("data"), F.lit(0)).cast("long").alias("size"))

    def number(parts):
        path, batch, n, size = None, 0, 0, 0
        for part in parts:
            out = []
            for p, s in zip(part["path"], part["size"]):
                if p != path:
                    path, batch, n, size = p, 0, 0, 0
                out.append(batch)
                n, size = n + 1, size + s
                if n >= count or size >= target_bytes:
                    batch, n, size = batch + 1, 0, 0
            yield pd.DataFrame({"path": part["path"], "record_ordinal": part["record_ordinal"], "size": part["size"], "batch": out})

    return rows.repartition("path").sortWithinPartitions("path", "record_ordinal").mapInPandas(number, "path string, record_ordinal long, size long, batch long")
