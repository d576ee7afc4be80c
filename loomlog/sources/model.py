"""Spark schemas of the container's tables."""

from __future__ import annotations

from pyspark.sql import types as T

_L, _I, _S, _B, _D = T.LongType(), T.IntegerType(), T.StringType(), T.BinaryType(), T.DecimalType(20, 0)
_M = T.MapType(_S, _S)
_N = T.MapType(_I, _L)

#: Columns that are unsigned 64-bit numbers and become DECIMAL(20, 0) on request.
U64 = frozenset({"log_time", "publish_time", "create_time", "start_time", "end_time", "message_start_time", "message_end_time"})

#: Where a row comes from: the file and its place in file order.
_WHERE = [("path", _S), ("chunk_ordinal", _I), ("record_ordinal", _L)]

_TABLES: dict[str, list[tuple[str, T.DataType]]] = {
    "messages": [*_WHERE, ("channel_id", _I), ("sequence", _L), ("log_time", _L), ("publish_time", _L), ("topic", _S), ("message_encoding", _S), ("schema_id", _I), ("data", _B)],
    "schemas": [*_WHERE, ("id", _I), ("name", _S), ("encoding", _S), ("data", _B)],
    "channels": [*_WHERE, ("id", _I), ("schema_id", _I), ("topic", _S), ("message_encoding", _S), ("metadata", _M)],
    "metadata": [*_WHERE, ("name", _S), ("values", _M)],
    "attachments": [*_WHERE, ("log_time", _L), ("create_time", _L), ("name", _S), ("media_type", _S), ("data", _B), ("crc", _L)],
    "records": [*_WHERE, ("opcode", _I), ("in_summary", T.BooleanType()), ("body", _B)],
    "chunks": [*_WHERE, ("start_time", _L), ("end_time", _L), ("uncompressed_size", _L), ("uncompressed_crc", _L), ("compression", _S), ("data", _B)],
    "header": [*_WHERE, ("profile", _S), ("library", _S)],
    "footer": [*_WHERE, ("summary_start", _L), ("summary_offset_start", _L), ("summary_crc", _L)],
    "statistics": [("path", _S), ("message_count", _L), ("schema_count", _I), ("channel_count", _L), ("attachment_count", _L), ("metadata_count", _L), ("chunk_count", _L), ("message_start_time", _L), ("message_end_time", _L), ("channel_message_counts", _N)],
    "chunk_index": [("path", _S), ("start_time", _L), ("end_time", _L), ("chunk_start_offset", _L), ("chunk_length", _L), ("message_index_offsets", _N), ("message_index_length", _L), ("compression", _S), ("compressed_size", _L), ("uncompressed_size", _L)],
    "message_index": [("path", _S), ("chunk_start_offset", _L), ("channel_id", _I), ("log_time", _L), ("offset", _L)],
    "attachment_index": [("path", _S), ("offset", _L), ("length", _L), ("log_time", _L), ("create_time", _L), ("data_size", _L), ("name", _S), ("media_type", _S)],
    "metadata_index": [("path", _S), ("offset", _L), ("length", _L), ("name", _S)],
    "summary_offsets": [*_WHERE, ("group_opcode", _I), ("group_start", _L), ("group_length", _L)],
    "validation": [("path", _S), ("ok", T.BooleanType()), ("records", _L), ("messages", _L), ("error_kind", _S), ("details", _M), ("validation_scope", _S)],
}

TABLES = tuple(_TABLES)


def schema_of(table: str, u64: str = "long") -> T.StructType:
    if table not in _TABLES:
        raise ValueError(f"unknown table {table!r}; one of {', '.join(TABLES)}")
    if u64 not in ("long", "decimal"):
        raise ValueError("u64 is 'long' or 'decimal'")
    return T.StructType([T.StructField(n, _D if u64 == "decimal" and n in U64 else t) for n, t in _TABLES[table]])


#: What a sink row may hold; ``kind`` says what the row is, columns that it doesn't use are null or missing.
SINK = T.StructType(
    [T.StructField(n, t) for n, t in (
        ("kind", _S), ("channel_id", _I), ("topic", _S), ("message_encoding", _S), ("schema_id", _I), ("schema_name", _S), ("schema_encoding", _S), ("schema_data", _B), ("channel_metadata", _M),
        ("sequence", _L), ("log_time", _L), ("publish_time", _L), ("data", _B), ("name", _S), ("media_type", _S), ("create_time", _L), ("values", _M), ("opcode", _I), ("length", _L), ("in_chunks", T.BooleanType()),
    )]
)
