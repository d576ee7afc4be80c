"""Messages as columns: the records of a chunk decoded to Arrow, and Arrow columns encoded as records.

Only the places of the records are found one by one; headers and payloads then move by numpy and Arrow kernels.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from loomlog.sources import format as f
from loomlog.sources.errors import LogError

#: Record prefix and message header as they stand in the file.
HEAD = np.dtype([("opcode", "u1"), ("length", "<u8"), ("channel_id", "<u2"), ("sequence", "<u4"), ("log_time", "<u8"), ("publish_time", "<u8")])
_LENGTH = struct.Struct("<Q")


class Records:
    """The records of a chunk: where each starts, its opcode, and the headers of the messages among them."""

    def __init__(self, data: bytes, limit: int | None = None):
        starts, at, size, length = [], 0, len(data), _LENGTH.unpack_from
        while at < size:
            if at + f.PREFIX > size:
                raise LogError("UnexpectedEoc", "a record prefix is cut short")
            n = length(data, at + 1)[0]
            if limit is not None and n > limit:
                raise LogError("RecordTooLarge", opcode=data[at], len=n)
            if n > size - at - f.PREFIX:
                raise LogError("UnexpectedEoc", "a record is cut short")
            starts.append(at)
            at += f.PREFIX + n
        self.data, raw = data, np.frombuffer(data, np.uint8)
        self.starts = np.array([*starts, size], dtype=np.int64)
        self.opcodes = raw[self.starts[:-1]] if starts else np.zeros(0, np.uint8)
        self.where = np.flatnonzero(self.opcodes == f.MESSAGE)
        own = self.starts[self.where]
        if (self.starts[self.where + 1] - own < HEAD.itemsize).any():
            raise LogError("Parse", "a message header is cut short", source="field beyond the body")
        view = np.lib.stride_tricks.sliding_window_view(raw, HEAD.itemsize) if len(own) else np.zeros((0, HEAD.itemsize), np.uint8)
        self.heads = np.ascontiguousarray(view[own]).view(HEAD).ravel()

    def body(self, i: int) -> memoryview:
        return memoryview(self.data)[self.starts[i] + f.PREFIX : self.starts[i + 1]]

    def sizes(self) -> np.ndarray:
        """Payload bytes of each message."""
        return self.starts[self.where + 1] - self.starts[self.where] - HEAD.itemsize

    def payloads(self, chosen: np.ndarray) -> pa.Array:
        """Payloads of the chosen messages (numbers among the messages)."""
        bounds = np.empty(2 * len(self.starts) - 1, np.int64)
        bounds[0::2] = self.starts
        bounds[1::2] = np.minimum(self.starts[:-1] + HEAD.itemsize, self.starts[1:])
        parts = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(self.data)])
        return parts.take(pa.array(2 * self.where[chosen] + 1)).cast(pa.binary())


def encoded(channel_id: np.ndarray, sequence: np.ndarray, log_time: np.ndarray, publish_time: np.ndarray, data: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Message records as one run of bytes, and the n+1 offsets of the records in it. No payload is null."""
    head = np.empty(len(data), HEAD)
    head["opcode"] = f.MESSAGE
    head["length"] = pc.binary_length(data).to_numpy() + (HEAD.itemsize - f.PREFIX)
    for name, values in (("channel_id", channel_id), ("sequence", sequence), ("log_time", log_time), ("publish_time", publish_time)):
        head[name] = values
    heads = pa.Array.from_buffers(pa.binary(HEAD.itemsize), len(head), [None, pa.py_buffer(head)])
    out = pc.binary_join_element_wise(heads.cast(pa.large_binary()), data.cast(pa.large_binary()), pa.scalar(b"", pa.large_binary()))
    _, offsets, raw = out.buffers()
    at = np.frombuffer(offsets, np.int64)[out.offset : out.offset + len(out) + 1]
    return np.frombuffer(raw, np.uint8)[at[0] : at[-1]], at - at[0]
