"""Joins of messages with declarations and indexes: resolution, seeks, forwarding, pruning, as-of."""

from __future__ import annotations

import json
from collections import OrderedDict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomlog.session import ship
from loomlog.sources import columnar, datasource, files, model
from loomlog.sources import format as f
from loomlog.sources import reading as r
from loomlog.sources.errors import LogError
from loomlog.sources.tables import read_table

#: Requests that a grouped seek takes.
MAX_SEEKS = 65_536


def resolve(messages: DataFrame, channels: DataFrame, schemas: DataFrame, scope: list[str] | None = None) -> DataFrame:
    """Messages with channel and schema columns; an unknown channel is an error of the job, no schema is null.

    ``scope`` are the columns that ids belong to (the recording). Declarations of one recording are small by the
    format; of many recordings they are not, so the planner chooses the join from the sizes it finds.
    """
    bad = F.raise_error(F.concat(F.lit("UnknownChannel: a message refers to channel "), F.col("channel_id").cast("string")))
    # In a generator of one row the check is neither pruned nor moved, whichever columns are asked for later.
    found = resolve_raw(messages, channels, schemas, scope, known="__known")
    checked = F.explode(F.array(F.when(F.col("__known"), F.lit(True)).otherwise(bad.cast("boolean"))))
    return found.select("*", checked.alias("__checked")).where("__checked").drop("__known", "__checked")


def resolve_raw(messages: DataFrame, channels: DataFrame, schemas: DataFrame, scope: list[str] | None = None, known: str | None = None) -> DataFrame:
    """The same with unknown channels kept, their columns null; ``known`` names a column that tells whether a channel was found."""
    scope = scope or []
    own = channels.select(*scope, F.col("id").alias("channel_id"), "topic", "message_encoding", "schema_id", *([F.lit(True).alias(known)] if known else []))
    declared = schemas.select(*scope, F.col("id").alias("schema_id"), F.col("name").alias("schema_name"), F.col("encoding").alias("schema_encoding"))
    bare = messages.drop("topic", "message_encoding", "schema_id")
    return bare.join(own, [*scope, "channel_id"], "left").join(declared, [*scope, "schema_id"], "left")


def unknown_references(uses: DataFrame, declared: DataFrame, on: list[str]) -> DataFrame:
    """Uses without a declaration."""
    return uses.join(declared.select(*on).distinct(), on, "left_anti")


def used_before_declared(uses: DataFrame, declared: DataFrame, on: list[str], order: str = "record_ordinal") -> DataFrame:
    """Uses whose first declaration comes after them, or never: the summary's declarations don't count here."""
    first = declared.groupBy(*on).agg(F.min(order).alias("declared_at"))
    return uses.join(first, on, "left").where(F.col("declared_at").isNull() | (F.col("declared_at") > F.col(order)))


def prune_chunks(index: DataFrame, start: int | None = None, end: int | None = None, channel_ids: list[int] | None = None) -> DataFrame:
    """Chunks whose time range meets [start, end) and that hold a wanted channel."""
    out = index
    if start is not None:
        out = out.where(F.col("end_time") >= start)
    if end is not None:
        out = out.where(F.col("start_time") < end)
    if channel_ids is not None:
        out = out.where(F.arrays_overlap(F.map_keys("message_index_offsets"), F.array(*[F.lit(int(c)) for c in channel_ids])) if channel_ids else F.lit(False))
    return out


def seek(messages: DataFrame, requests: DataFrame, on: list[str]) -> DataFrame:
    """Messages by exact place. All requests must hit; the log time of a request plays no part."""
    return requests.join(messages, on, "left")


def checked_seek(messages: DataFrame, requests: DataFrame, on: list[str], order: str = "req_no") -> DataFrame:
    """Grouped seeks: duplicates kept, in request order, all or nothing, 1 to MAX_SEEKS requests."""
    n = requests.limit(MAX_SEEKS + 1).count()
    if not 1 <= n <= MAX_SEEKS:
        raise ValueError(f"a grouped seek takes 1 to {MAX_SEEKS} requests")
    marked = messages.withColumn("found", F.lit(True))
    out = seek(marked, F.broadcast(requests), on)  # at most MAX_SEEKS rows, counted above
    if out.where("found is null").limit(1).count():
        raise LogError("BadIndex", "a request points to no message")
    return out.drop("found").orderBy(order)


class Chunks:
    """Decoded chunks of recordings by place, those used last, up to ``most`` bytes: a chunk beyond that is not kept, and
    with 0 none is. One recording is open at a time."""

    def __init__(self, most: int):
        self.most, self.held, self.kept = most, 0, OrderedDict()
        self.path, self.data, self.indexes = None, None, {}

    def at(self, path: str, start: int) -> tuple[columnar.Records, dict[int, int], bool]:
        """Records of a chunk, their numbers by offset, and whether the chunk had to be loaded."""
        if (path, start) in self.kept:
            self.kept.move_to_end((path, start))
            return *self.kept[path, start][:2], False
        self._open(path)
        if start not in self.indexes:
            raise LogError("BadIndex", "a request names no chunk")
        raw = f.expand(r.chunk_at(self.data, self.indexes[start]))
        records = columnar.Records(raw)
        places = {int(records.starts[i]): i for i in records.where.tolist()}
        if len(raw) <= self.most:
            self.kept[path, start] = records, places, len(raw)
            self.held += len(raw)
            while self.held > self.most:
                self.held -= self.kept.popitem(last=False)[1][2]
        return records, places, True

    def _open(self, path: str) -> None:
        if path != self.path:
            self.close()
            self.path, self.data = path, files.opened(path)
            summary = r.read_summary(self.data, declarations=False)
            self.indexes = {i.chunk_start_offset: i for i in (summary.chunk_indexes if summary else [])}

    def close(self) -> None:
        if self.data is not None:
            self.data.close()
        self.path = self.data = None


def _sought(most: int | None):
    """Requests -> the messages they point to, in their order. Without ``most`` requests are sorted by recording and
    chunk, and a chunk is held until another one is asked for; else see Chunks."""

    def sought(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, here, now = Chunks(most or 0), None, None
        try:
            for batch in batches:
                out = []
                for path, start, at, number in zip(*(batch.column(i).to_pylist() for i in range(4))):
                    loaded = False
                    if most is not None or here != (path, start):
                        here, (*now, loaded) = (path, start), chunks.at(path, start)
                    records, places = now
                    if at not in places:
                        raise LogError("BadIndex", "a request points to no message")
                    m = r.message_of(records.body(places[at]))
                    out.append((path, start, at, number, m.channel_id, m.sequence, m.log_time, m.publish_time, m.data, loaded))
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], type=k) for i, k in enumerate(kinds)], names=[c.split(" ")[0] for c in SOUGHT.split(", ")])
        finally:
            chunks.close()

    return sought


SOUGHT = "path string, chunk_start_offset long, offset long, req_no long, channel_id int, sequence long, log_time long, publish_time long, data binary, loaded boolean"


def _requests(requests: DataFrame) -> DataFrame:
    ship(requests.sparkSession)
    number = F.col("req_no").cast("long") if "req_no" in requests.columns else F.lit(None).cast("long")
    return requests.select("path", "chunk_start_offset", "offset", number.alias("req_no"))


def seek_in_place(requests: DataFrame, cache_bytes: int = 64 << 20) -> DataFrame:
    """The same as seek_messages() without a shuffle, in the order in which partitions hold their requests, for requests
    that come near each other already. Each task keeps up to ``cache_bytes`` of decoded chunks, the least recently used
    going first. ``loaded`` tells the requests that loaded their chunk from those that found it."""
    if cache_bytes < 0:
        raise ValueError("cache_bytes is not negative")
    return _requests(requests).mapInArrow(_sought(int(cache_bytes)), SOUGHT)


def seek_messages(requests: DataFrame) -> DataFrame:
    """Messages at (path, chunk_start_offset, offset), with the request's number req_no if it has one.

    Requests meet by chunk, so each chunk is loaded by one task and once, however many recordings and requests there
    are; duplicates are kept. A request that points to no message fails the job: all or nothing. The log time of a
    request plays no part.
    """
    by_chunk = _requests(requests).repartition("path", "chunk_start_offset").sortWithinPartitions("path", "chunk_start_offset")
    return by_chunk.mapInArrow(_sought(None), SOUGHT).drop("loaded")


def grouped_seek(requests: DataFrame) -> DataFrame:
    """1 to MAX_SEEKS requests with req_no, answered in the order of their numbers."""
    if not 1 <= requests.limit(MAX_SEEKS + 1).count() <= MAX_SEEKS:
        raise ValueError(f"a grouped seek takes 1 to {MAX_SEEKS} requests")
    return seek_messages(requests).orderBy("req_no")


def read_chunk(spark: SparkSession, path: str, chunk_start: int) -> DataFrame:
    """Messages of one chunk by its offset."""
    return read_table(spark, path, access="indexed", chunkStarts=[chunk_start])


def read_indexed(index: DataFrame, table: str) -> DataFrame:
    """Attachments or metadata at (path, offset) of an index, of any number of recordings; each task opens its own."""
    spark = index.sparkSession
    ship(spark)
    schema = model.schema_of(table)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places: dict[str, list[int]] = {}
            for path, offset in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                places.setdefault(path, []).append(offset)
            for path, offsets in places.items():
                reader = datasource.LogReader(schema, {"path": path, "table": table, "offsets": json.dumps(offsets)})
                yield from reader.read(datasource.Part(path))

    return index.select("path", "offset").repartition("path", (F.col("offset") / F.lit(64 << 20)).cast("long")).mapInArrow(read, schema)


def chunks_of(spark: SparkSession, path: str) -> DataFrame:
    """Chunks joined with their indexes: opcode and length must match, as the reader checks."""
    index = read_table(spark, path, "chunk_index").select("path", "chunk_start_offset", "chunk_length", "message_index_offsets")
    chunks = read_table(spark, path, "chunks").withColumn("chunk_start_offset", F.expr("shiftright(record_ordinal, 24)"))
    return index.join(chunks, ["path", "chunk_start_offset"])


def forward(messages: DataFrame, id_map: DataFrame) -> DataFrame:
    """Messages with channel ids replaced; id_map: channel_id, new_id. The planner chooses the join from the map's size."""
    return messages.join(id_map, "channel_id").withColumn("channel_id", F.col("new_id")).drop("new_id")


def as_of(left: DataFrame, right: DataFrame, by: list[str], time: str, value: str) -> DataFrame:
    """For each left row the last right value at or before its time (right rows first on ties)."""
    tagged = left.withColumns({"__side": F.lit(1), "__value": F.lit(None).cast(dict(right.dtypes)[value])})
    other = right.select(*by, time, F.lit(0).alias("__side"), F.col(value).alias("__value"))
    both = tagged.unionByName(other, allowMissingColumns=True)
    w = Window.partitionBy(*by).orderBy(time, "__side").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn(value, F.last("__value", ignorenulls=True).over(w)).where("__side = 1").drop("__side", "__value")


def interval_join(points: DataFrame, spans: DataFrame, time: str, start: str, end: str, width: int) -> DataFrame:
    """Points with start <= time < end, by buckets of ``width`` instead of comparing all pairs."""
    bucket = lambda c: F.expr(f"{c} div {int(width)}")
    wide = spans.where(F.col(end) > F.col(start)).withColumn("__bucket", F.explode(F.sequence(bucket(start), F.expr(f"({end} - 1) div {int(width)}"))))
    return points.withColumn("__bucket", bucket(time)).join(wide, "__bucket").where((F.col(time) >= F.col(start)) & (F.col(time) < F.col(end))).drop("__bucket")
