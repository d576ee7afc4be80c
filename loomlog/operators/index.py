"""Statistics and indexes derived from message tables by ordinary aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Bytes of a message in a chunk beside its payload: record prefix and message header.
OVERHEAD = 9 + 22


def statistics(messages: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Message count and range of log_time, for each group (by default each recording)."""
    return messages.groupBy(*(["path"] if by is None else by)).agg(F.count("*").alias("message_count"), F.min("log_time").alias("message_start_time"), F.max("log_time").alias("message_end_time"))


def channel_counts(messages: DataFrame, by: list[str] | None = None) -> DataFrame:
    return messages.groupBy(*([] if by is None else by), "channel_id").agg(F.count("*").alias("message_count"))


def channel_count_map(messages: DataFrame) -> DataFrame:
    """The counts as one map for each recording, as statistics records hold them."""
    counts = channel_counts(messages, ["path"])
    return counts.groupBy("path").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("channel_id", "message_count")))).alias("channel_message_counts"))


def chunk_index(messages: DataFrame, chunk: str = "chunk_ordinal", size: str | None = None) -> DataFrame:
    """Time range, messages and bytes of every chunk."""
    payload = F.col(size) if size else F.octet_length("data")
    return messages.where(F.col(chunk) >= 0).groupBy(chunk).agg(F.min("log_time").alias("start_time"), F.max("log_time").alias("end_time"), F.count("*").alias("message_count"), F.sum(payload + OVERHEAD).cast("long").alias("uncompressed_size"))


def message_index(messages: DataFrame, chunk: str = "chunk_ordinal", order: str = "record_ordinal", size: str | None = None) -> DataFrame:
    """Offset of every message among its chunk's messages: a running sum inside the chunk."""
    payload = F.col(size) if size else F.octet_length("data")
    before = Window.partitionBy(chunk).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return messages.select(chunk, "channel_id", "log_time", F.coalesce(F.sum(payload + OVERHEAD).over(before), F.lit(0)).cast("long").alias("offset"))


#: Rows of a range that one task orders, on average.
RANGE_ROWS = 50_000


def logical_chunks(messages: DataFrame, order: str, size: str, target: int) -> DataFrame:
    """Adds chunk_id: messages in the given order are cut where the bytes before them pass multiples of target.

    The running sum over the whole table is made of sums of ranges of the order key and sums inside each range, so no
    task orders everything.
    """
    low, high, n = messages.agg(F.min(order), F.max(order), F.count("*")).first()
    low, high = (0, 0) if low is None else (int(low), int(high))
    blocks = max(1, -(-n // RANGE_ROWS))
    rows = messages.withColumn("block", F.expr(f"cast(({order} - {low}L) div {max(1, -(-(high - low + 1) // blocks))}L as int)"))
    sums = rows.groupBy("block").agg(F.sum(F.col(size) + OVERHEAD).alias("s"))
    prior = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("block", F.coalesce(F.sum("s").over(prior), F.lit(0)).alias("base"))
    inside = Window.partitionBy("block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    own = rows.withColumn("inside", F.coalesce(F.sum(F.col(size) + OVERHEAD).over(inside), F.lit(0)))
    return own.join(starts, "block").withColumn("chunk_id", F.expr(f"(base + inside) div {target}")).drop("block", "base", "inside")


def attachment_index(attachments: DataFrame) -> DataFrame:
    return attachments.select("name", "media_type", "log_time", "create_time", F.octet_length("data").cast("long").alias("data_size"))


def metadata_index(metadata: DataFrame) -> DataFrame:
    return metadata.select("path", (F.shiftright("record_ordinal", 24)).alias("offset"), "name")


def conflicting_ids(declared: DataFrame, by: list[str], content: list[str]) -> DataFrame:
    """Ids with more than one content; maps are compared as sorted entries."""
    types = dict(declared.dtypes)
    columns = [F.sort_array(F.map_entries(c)) if types[c].startswith("map") else F.col(c) for c in content]
    found = declared.groupBy(*by).agg(F.count_distinct(F.struct(*[F.coalesce(F.to_json(F.struct(c)), F.lit("")) for c in columns])).alias("contents"))
    return found.where("contents > 1")
