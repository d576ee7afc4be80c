"""Validation and recovery, with findings as data."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from loomlog.sources import columnar
from loomlog.sources import format as f
from loomlog.sources.errors import LogError
from loomlog.sources.tables import read_table


def validation_report(spark: SparkSession, path: str) -> DataFrame:
    """One row a recording: ok, records, messages, error kind and details; recordings are checked in parallel."""
    return read_table(spark, path, "validation")


def validate(spark: SparkSession, path: str) -> int:
    """Records of all recordings; raises the first failure by path. Every recording is read once."""
    failure = F.min_by(F.struct("path", "error_kind", "details"), F.when(~F.col("ok"), F.col("path")))
    total, bad = validation_report(spark, path).agg(F.sum("records"), failure).first()
    if bad is not None:
        raise LogError(bad["error_kind"], f"{bad['path']} is not valid", **(bad["details"] or {}))
    return total or 0


def recover(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Messages of the valid prefix of each recording, and the report on what ended it."""
    report = validation_report(spark, path).select("path", F.col("ok").alias("fully_validated"), F.col("messages").alias("recovered_messages"), "error_kind", "details")
    return read_table(spark, path, mode="recover"), report


def recover_each(spark: SparkSession, path: str, call: Callable[[Row], None]) -> DataFrame:
    """Calls ``call`` on the executors with every message of the valid prefixes, in file order in each recording; what it
    raises ends the job and is not taken for damage. The report on what ended the prefixes is returned. A task that is
    repeated calls again."""
    messages, report = recover(spark, path)
    messages.foreach(call)
    return report


def _chunk_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            data = f.decompress(row["compression"], row["data"], row["uncompressed_size"])
            out.append((row["path"], "chunk", row["record_ordinal"], row["uncompressed_crc"], zlib.crc32(data), len(columnar.Records(data).where), len(data)))
        yield _sums(out)


def _attachment_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for path, ordinal, body in zip(*(batch.column(i).to_pylist() for i in range(3))):
            out.append((path, "attachment", ordinal, int.from_bytes(body[-4:], "little"), zlib.crc32(body[:-4]), 0, len(body)))
        yield _sums(out)


_KINDS = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
_SUMS = "path string, kind string, record_ordinal long, stored_crc long, computed_crc long, messages long, bytes long"


def _sums(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], type=k) for i, k in enumerate(_KINDS)], names=[c.split(" ")[0] for c in _SUMS.split(", ")])


def crc_report(spark: SparkSession, path: str) -> DataFrame:
    """Stored checksums against computed ones, for every chunk (over its records) and every attachment; ``ok`` is null
    where none is stored. The checksums of data section and summary speak of whole recordings: the validation has them."""
    chunks = read_table(spark, path, "chunks").select("path", "record_ordinal", "compression", "uncompressed_size", "uncompressed_crc", "data")
    bodies = read_table(spark, path, "records", expandChunks="false").where(F.col("opcode") == f.ATTACHMENT).select("path", "record_ordinal", "body")
    sums = chunks.mapInArrow(_chunk_sums, _SUMS).unionByName(bodies.mapInArrow(_attachment_sums, _SUMS))
    return sums.withColumn("ok", F.when(F.col("stored_crc") != 0, F.col("stored_crc") == F.col("computed_crc")))
