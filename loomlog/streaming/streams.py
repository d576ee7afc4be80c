"""Recordings as streams: completed files as a source, micro-batches as a sink, windows on an explicit clock."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlog.functions.records import timestamp
from loomlog.sources import datasource
from loomlog.sources.tables import register


def read_stream(spark: SparkSession, path: str, table: str = "messages", **options) -> DataFrame:
    """Rows of recordings as they are completed under a folder; with mode='recover' the valid prefix of each, with
    follow='true' the messages of recordings that are still being written, as far as their records are complete."""
    register(spark)
    named = {k: v if isinstance(v, str) else json.dumps(v) for k, v in options.items() if v is not None}
    return spark.readStream.format(datasource.NAME).options(table=table, **named).load(path)


def write_stream(stream: DataFrame, path: str, checkpoint: str, **options):
    """A query that writes every micro-batch as recordings; repeating a batch adds nothing."""
    from loomlog.sources import model

    register(stream.sparkSession)
    have = set(stream.columns)
    columns = [(F.col(x.name) if x.name in have else F.lit(None)).cast(x.dataType).alias(x.name) for x in model.SINK]
    return stream.select(*columns).writeStream.format(datasource.NAME).options(path=path, checkpointLocation=checkpoint, **{k: str(v) for k, v in options.items()})


def windowed_counts(messages: DataFrame, width: str, lateness: str, slide: str | None = None) -> DataFrame:
    """Messages by topic in tumbling or sliding windows of log_time as nanoseconds since 1970, late rows dropped after
    ``lateness``. The container itself gives times no origin: asking for windows is a statement about it."""
    timed = messages.withColumn("at", timestamp(F.col("log_time"))).withWatermark("at", lateness)
    window = F.window("at", width, slide) if slide else F.window("at", width)
    return timed.groupBy(window.alias("w"), "topic").agg(F.count("*").alias("messages")).select("topic", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "messages")
