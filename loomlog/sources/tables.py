"""Recordings as DataFrames: the entry points over the data source."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomlog.session import ship
from loomlog.sources import datasource, model
from loomlog.sources import format as f


def register(spark: SparkSession) -> None:
    """Make ``messagelog`` known to the session, and this package to its workers."""
    ship(spark)
    spark.dataSource.register(datasource.MessageLog)


def read_table(spark: SparkSession, path: str, table: str = "messages", **options) -> DataFrame:
    """Any table of the recordings under a path; options as the source names them."""
    register(spark)
    if str(options.get("pushdown")).lower() == "true":
        # Without this setting Spark refuses a reader that takes filters; it changes nothing for other sources.
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format(datasource.NAME).options(table=table, **{k: v if isinstance(v, str) else json.dumps(v) for k, v in options.items() if v is not None}).load(path)


def write_recordings(df: DataFrame, path: str, mode: str = "append", **options) -> None:
    """Rows of the sink's schema (missing columns are null) as recordings, one for each partition."""
    register(df.sparkSession)
    have = {c.lower(): c for c in df.columns}
    columns = [(F.col(f"`{have[x.name]}`") if x.name in have else F.lit(None)).cast(x.dataType).alias(x.name) for x in model.SINK]
    df.select(*columns).write.format(datasource.NAME).options(**{k: str(v) for k, v in options.items()}).mode(mode).save(path)


def first_declarations(declared: DataFrame) -> DataFrame:
    """The first declaration of each id of a recording."""
    by_id = Window.partitionBy("path", "id").orderBy("record_ordinal")
    return declared.withColumn("rank", F.row_number().over(by_id)).where("rank = 1").drop("rank")


def schemas(spark: SparkSession, path: str, **options) -> DataFrame:
    return first_declarations(read_table(spark, path, "schemas", **options))


def channels(spark: SparkSession, path: str, **options) -> DataFrame:
    """Channels, each once, with their schemas; a channel without one has nulls there."""
    own = first_declarations(read_table(spark, path, "channels", **options))
    known = schemas(spark, path, **options).select("path", F.col("id").alias("schema_id"), F.col("name").alias("schema_name"), F.col("encoding").alias("schema_encoding"), F.col("data").alias("schema_data"))
    return own.join(known, ["path", "schema_id"], "left")


def summary_records(spark: SparkSession, path: str) -> DataFrame:
    """All summary records in order (channels, schemas, statistics, indexes) as JSON of all columns; no rows without a summary."""
    register(spark)
    parts = []
    for k, table in enumerate(("channels", "schemas", "statistics", "chunk_index", "attachment_index", "metadata_index")):
        rows = read_table(spark, path, table)
        parts.append(rows.select("path", F.lit(k).alias("group_order"), F.lit(table).alias("group"), F.to_json(F.struct(*(c for c in rows.columns if c != "path"))).alias("record")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def written(spark: SparkSession, path: str) -> DataFrame:
    """What the sink's jobs left under a path: recording, rows, rejected rows, and statistics even where none are stored."""
    counts = "message_count long, schema_count long, channel_count long, attachment_count long, metadata_count long, chunk_count long, message_start_time long, message_end_time long, channel_message_counts map<string,long>"
    return _side_files(spark, path, datasource.REPORT, f"job string, recording string, rows long, rejected long, statistics struct<{', '.join(c.replace(' ', ':', 1) for c in counts.split(', '))}>")


def rejected(spark: SparkSession, path: str) -> DataFrame:
    """Rows that badRows=QUARANTINE put aside: the recording, the row's number in its task, why, and the row as JSON (bytes as hex)."""
    return _side_files(spark, path, datasource.REJECTS, "recording string, row_number long, reason string, row string")


def _side_files(spark: SparkSession, path: str, prefix: str, schema: str) -> DataFrame:
    # Spark passes over names that begin with a mark, so the files are listed here and read as text.
    from loomlog.sources import files

    names = files.side_files(path, prefix)
    lines = spark.createDataFrame([(n,) for n in names], "file string").repartition(max(1, min(len(names), 200)))

    def content(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with files.opened(name) as data:
                    yield pa.RecordBatch.from_arrays([pa.array(data.read().decode("utf-8").splitlines(), type=pa.string())], names=["value"])

    ship(spark)
    return lines.mapInArrow(content, "value string").select(F.from_json("value", schema).alias("x")).select("x.*")


# -- bytes that only Spark can read ---------------------------------------------------------------------------------------
def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """binaryFile rows (path, content) -> messages."""
    import io

    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            reader = datasource.LogReader(model.schema_of("messages"), {"path": path, "access": "scan"})
            yield from reader.batches(datasource.Part(path), io.BytesIO(content.as_buffer()))


def read_binary(spark: SparkSession, path: str, pattern: str = "*.mlog") -> DataFrame:
    """Messages of recordings on any store that Spark itself reads (whole files, up to 2 GB each)."""
    ship(spark)
    content = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "content")
    return content.mapInArrow(decode, model.schema_of("messages"))


def expand_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the chunks table -> their records: path, chunk_ordinal, index, opcode, body."""
    names = ["path", "chunk_ordinal", "index", "opcode", "body"]
    for batch in batches:
        for row in batch.to_pylist():
            chunk = f.Chunk(row["start_time"], row["end_time"], row["uncompressed_size"], row["uncompressed_crc"], row["compression"], row["data"])
            found = [(row["path"], row["chunk_ordinal"], i, op, bytes(b)) for i, (_, op, b) in enumerate(f.walk(f.expand(chunk)))]
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], type=t) for k, t in enumerate(kinds)], names=names)


def expanded(chunks: DataFrame) -> DataFrame:
    ship(chunks.sparkSession)
    return chunks.mapInArrow(expand_chunk, "path string, chunk_ordinal int, index int, opcode int, body binary")


def wanted_topics(topics: Iterable[str] | None) -> str | None:
    return None if topics is None else json.dumps(sorted(topics))
