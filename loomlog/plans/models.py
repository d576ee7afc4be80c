"""Plain tables as message logs: how the driver's tables map to messages, attachments and metadata."""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlog.session import ensure_checkpoint_dir
from loomlog.sources import reading
from loomlog.sources.files import SUFFIX
from loomlog.sources.format import MESSAGE
from loomlog.sources.tables import write_recordings

#: Payload bytes of a logical chunk.
CHUNK_TARGET = 16_384


#: Ids have 16 bits.
MAX_IDS = 65_535


def numbered(names: DataFrame, column: str, name: str) -> DataFrame:
    """Distinct names with ids from 1 in name order, as a local table of at most MAX_IDS rows, so that joins broadcast it."""
    found = names.select(column).distinct().orderBy(column).limit(MAX_IDS + 1).collect()
    if len(found) > MAX_IDS:
        raise ValueError(f"a recording has at most {MAX_IDS} channels")
    return names.sparkSession.createDataFrame([(r[0], i) for i, r in enumerate(found, 1)], f"{column} string, {name} int")


def nanoseconds(column: str):
    return (F.unix_micros(F.col(column).cast("timestamp")) * 1000).cast("long")


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events: a channel for each event type, event_id as sequence, ts as both times, props as payload."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    ids = numbered(events, "event_type", "channel_id")
    return events.join(F.broadcast(ids), "event_type").select(
        "channel_id",
        F.concat(F.lit("/events/"), "event_type").alias("topic"),
        F.lit("json").alias("message_encoding"),
        F.col("event_id").alias("sequence"),
        nanoseconds("ts").alias("log_time"),
        nanoseconds("ts").alias("publish_time"),
        F.encode("props", "UTF-8").alias("data"),
    )


def conversation_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations: a channel for each role; the turn is the sequence and, for want of a clock, the time."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    ids = numbered(turns, "role", "channel_id")
    return turns.join(F.broadcast(ids), "role").select("channel_id", F.concat(F.lit("/conv/"), "role").alias("topic"), F.lit("text/plain").alias("message_encoding"), F.col("turn").alias("sequence"), F.col("turn").alias("log_time"), F.col("turn").alias("publish_time"), F.encode("text", "UTF-8").alias("data"), "conv_id")


def document_attachments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select(F.lit("attachment").alias("kind"), F.col("doc_id").cast("string").alias("name"), F.lit("text/plain").alias("media_type"), F.col("doc_id").alias("log_time"), F.lit(0).cast("long").alias("create_time"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("data"))


def nation_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    return nation.select(F.lit("metadata").alias("kind"), F.concat(F.lit("nation/"), "n_nationkey").alias("name"), F.create_map(F.lit("name"), "n_name", F.lit("region"), F.col("n_regionkey").cast("string")).alias("values"))


_RECORDED: dict[tuple, str] = {}


def with_schemas(messages: DataFrame) -> DataFrame:
    """Channels with even ids get a schema of their number."""
    own = lambda c: F.when(F.col("channel_id") % 2 == 0, c)
    return messages.withColumns({"schema_id": own(F.col("channel_id")), "schema_name": own(F.concat(F.lit("schema"), "channel_id")), "schema_encoding": own(F.lit("jsonschema")), "schema_data": own(F.lit(b"{}"))})


def with_late_declarations(messages: DataFrame, channels: list[tuple[int, str]], after: int) -> DataFrame:
    """Adds a private record that holds each channel's declaration behind the ``after``-th place from its first message."""
    from loomlog.sources import format as f

    bodies = messages.sparkSession.createDataFrame([(c, bytearray(f.body_of(f.Channel(c, 0, t, "json", {})))) for c, t in channels], "channel_id int, body binary")
    first = messages.groupBy("channel_id").agg((F.min("sequence") + after - 1).alias("sequence")).join(bodies, "channel_id")
    late = first.select(F.lit("private").alias("kind"), "sequence", F.col("body").alias("data"), F.lit(LATE).alias("opcode"))
    return messages.withColumn("kind", F.lit("message")).unionByName(late, allowMissingColumns=True)


#: Opcode under which with_late_declarations() keeps a declaration until retyped() makes it one.
LATE = 0x84


def changed(path: str, name: str, change) -> str:
    """A copy of the recordings under a path, each changed by change(file); made once."""
    folder = f"{path}-{name}"
    if not os.path.isdir(folder):
        os.makedirs(f"{folder}.new")
        for n in sorted(os.listdir(path)):
            if n.endswith(SUFFIX):
                shutil.copyfile(os.path.join(path, n), f"{folder}.new/{n}")
                with open(f"{folder}.new/{n}", "r+b") as data:
                    change(data)
        os.rename(f"{folder}.new", folder)
    return folder


def growing(path: str, folder: str, steps: int) -> Iterator[str]:
    """A folder in which copies of the recordings under a path grow in so many steps; given after each of them."""
    os.makedirs(folder)
    names = sorted(n for n in os.listdir(path) if n.endswith(SUFFIX))
    for k in range(1, steps + 1):
        for n in names:
            size = os.path.getsize(os.path.join(path, n))
            with open(os.path.join(path, n), "rb") as data, open(os.path.join(folder, n), "ab") as out:
                data.seek(out.tell())
                shutil.copyfileobj(_Limited(data, size * k // steps - out.tell()), out)
        yield folder


class _Limited:
    """The next ``left`` bytes of a file."""

    def __init__(self, data, left: int):
        self.data, self.left = data, left

    def read(self, n: int) -> bytes:
        out = self.data.read(min(n, self.left))
        self.left -= len(out)
        return out


def retyped(opcodes: dict[int, int], channel: int | None = None):
    """Gives records outside chunks and summary other opcodes; of channel declarations only those of ``channel``, if given."""

    def change(data) -> None:
        found = []
        for x in reading.scan(data, expand=False):
            if x.opcode in opcodes and not x.in_summary and (channel is None or int.from_bytes(x.body[:2], "little") == channel):
                found.append((x.offset, opcodes[x.opcode]))
        for at, opcode in found:
            data.seek(at)
            data.write(bytes([opcode]))

    return change


def prefixed(junk: bytes):
    """Puts bytes before the recording."""

    def change(data) -> None:
        data.seek(0)
        raw = data.read()
        data.seek(0)
        data.write(junk + raw)

    return change


def cut_in_last_message(data) -> None:
    """Ends the recording in the middle of its last message."""
    at = 0
    for x in reading.scan(data, expand=False):
        if x.opcode == MESSAGE:
            at = x.offset
    data.truncate(at + 20)


def recorded(spark: SparkSession, sf_dir: str, what: str, rows, files: int | None = None, order: tuple[str, ...] = ("sequence",), **options) -> str:
    """Writes rows() as recordings in the shared folder, once for each session and set of options.

    Rows are dealt by ranges of sequence, so that file order is sequence order; without ``files`` there are as many
    recordings as the session has shuffle partitions.
    """
    key = (spark.sparkContext.applicationId, sf_dir, what, files, tuple(sorted(options.items())))
    if key not in _RECORDED or not os.path.isdir(_RECORDED[key]):
        folder = ensure_checkpoint_dir(spark)
        folder = folder[len("file:") :] if folder.startswith("file:") else folder
        path = os.path.join(folder, f"recordings-{what}-{uuid.uuid4().hex}")
        df = rows()
        if "sequence" in df.columns:
            n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
            df = df.repartitionByRange(n, "sequence").sortWithinPartitions(*order)
        write_recordings(df, path, **options)
        _RECORDED[key] = path
    return _RECORDED[key]
