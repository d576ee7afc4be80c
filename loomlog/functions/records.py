"""Column functions over record bodies and payloads."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from loomlog.sources import format as f


def _plain(value):
    if isinstance(value, bytes):
        return value.hex()
    if isinstance(value, dict):
        return {str(k): v for k, v in sorted(value.items())}
    if isinstance(value, list):
        return [list(v) for v in value]
    return value


def _parsed(opcode: pd.Series, body: pd.Series) -> pd.Series:
    out = []
    for op, b in zip(opcode, body):
        record = f.parse(int(op), b)
        out.append(json.dumps({"type": type(record).__name__, **{k: _plain(v) for k, v in record._asdict().items()}}, sort_keys=True))
    return pd.Series(out)


def parse_record(opcode: str, body: str) -> Column:
    """A record body as JSON of its fields by name; bytes as hex, unknown opcodes as their raw body."""
    return F.pandas_udf(_parsed, "string")(opcode, body)


def compressed(codec: str, data: str) -> Column:
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda x: None if x is None else f.compress(codec, bytes(x)))

    return F.pandas_udf(run, "binary")(data)


def decompressed(codec: str, data: str, size: str) -> Column:
    def run(values: pd.Series, sizes: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else f.decompress(codec, bytes(x), int(n)) for x, n in zip(values, sizes)])

    return F.pandas_udf(run, "binary")(data, size)


def payload(body: Column) -> Column:
    """A message body without its 22-byte header."""
    return F.substring(body, 23, 2**31 - 1)


def timestamp(log_time: Column) -> Column:
    """Nanoseconds since 1970 as a timestamp (microseconds); only where the origin is known to be 1970."""
    return F.timestamp_micros(F.floor(log_time.cast("decimal(20,0)") / F.lit(1000)).cast("long"))


def crc32(data: Column) -> Column:
    """The container's CRC-32 (0 stands for absent there)."""
    return F.crc32(data)
