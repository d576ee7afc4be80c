"""The container's wire format as pure functions over bytes.

A file is magic, records, magic. A record is an opcode (1 byte), the length of its body (8 bytes) and the body. All
numbers are little-endian; strings and collections have a 4-byte length in bytes before them.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from loomlog.sources.errors import LogError

# Fixed values of the format: magic bytes, opcodes, names of the codecs.
MAGIC = bytes.fromhex("894d434150300d0a")
HEADER, FOOTER, SCHEMA, CHANNEL, MESSAGE, CHUNK, MESSAGE_INDEX, CHUNK_INDEX = range(1, 9)
ATTACHMENT, ATTACHMENT_INDEX, STATISTICS, METADATA, METADATA_INDEX, SUMMARY_OFFSET, DATA_END = range(9, 16)
PRIVATE = 0x80
CODECS = ("", "lz4", "zstd")
PREFIX = 9
FOOTER_BODY = 20


class Header(NamedTuple):
    profile: str
    library: str


class Footer(NamedTuple):
    summary_start: int
    summary_offset_start: int
    summary_crc: int


class Schema(NamedTuple):
    id: int
    name: str
    encoding: str
    data: bytes


class Channel(NamedTuple):
    id: int
    schema_id: int
    topic: str
    message_encoding: str
    metadata: dict[str, str]


class Message(NamedTuple):
    channel_id: int
    sequence: int
    log_time: int
    publish_time: int
    data: bytes


class Chunk(NamedTuple):
    start_time: int
    end_time: int
    uncompressed_size: int
    uncompressed_crc: int
    compression: str
    data: bytes


class MessageIndex(NamedTuple):
    channel_id: int
    entries: list[tuple[int, int]]


class ChunkIndex(NamedTuple):
    start_time: int
    end_time: int
    chunk_start_offset: int
    chunk_length: int
    message_index_offsets: dict[int, int]
    message_index_length: int
    compression: str
    compressed_size: int
    uncompressed_size: int


class Attachment(NamedTuple):
    log_time: int
    create_time: int
    name: str
    media_type: str
    data: bytes
    crc: int


class AttachmentIndex(NamedTuple):
    offset: int
    length: int
    log_time: int
    create_time: int
    data_size: int
    name: str
    media_type: str


class Statistics(NamedTuple):
    message_count: int
    schema_count: int
    channel_count: int
    attachment_count: int
    metadata_count: int
    chunk_count: int
    message_start_time: int
    message_end_time: int
    channel_message_counts: dict[int, int]


class Metadata(NamedTuple):
    name: str
    values: dict[str, str]


class MetadataIndex(NamedTuple):
    offset: int
    length: int
    name: str


class SummaryOffset(NamedTuple):
    group_opcode: int
    group_start: int
    group_length: int


class DataEnd(NamedTuple):
    data_section_crc: int


class Raw(NamedTuple):
    opcode: int
    body: bytes


#: The shape of each body, one letter a field: b/h/i/q unsigned of 1, 2, 4, 8 bytes; s string; m map of strings;
#: n map of channel ids to numbers; p pairs of numbers; B bytes with a 4-byte, D with an 8-byte length; r the rest.
LAYOUTS: dict[int, tuple[type, str]] = {
    HEADER: (Header, "ss"),
    FOOTER: (Footer, "qqi"),
    SCHEMA: (Schema, "hssB"),
    CHANNEL: (Channel, "hhssm"),
    MESSAGE: (Message, "hiqqr"),
    CHUNK: (Chunk, "qqqisD"),
    MESSAGE_INDEX: (MessageIndex, "hp"),
    CHUNK_INDEX: (ChunkIndex, "qqqqnqsqq"),
    ATTACHMENT: (Attachment, "qqssDi"),
    ATTACHMENT_INDEX: (AttachmentIndex, "qqqqqss"),
    STATISTICS: (Statistics, "qhiiiiqqn"),
    METADATA: (Metadata, "sm"),
    METADATA_INDEX: (MetadataIndex, "qqs"),
    SUMMARY_OFFSET: (SummaryOffset, "bqq"),
    DATA_END: (DataEnd, "i"),
}
_NUMBER = {"b": struct.Struct("<B"), "h": struct.Struct("<H"), "i": struct.Struct("<I"), "q": struct.Struct("<Q")}
_PAIR, _ENTRY = struct.Struct("<QQ"), struct.Struct("<HQ")
_PREFIX = struct.Struct("<BQ")


class _Cursor:
    def __init__(self, body, opcode: int):
        self.body, self.at, self.opcode = memoryview(body), 0, opcode

    def take(self, n: int, what: str = "Parse", **details) -> memoryview:
        if n > len(self.body) - self.at:
            raise LogError(what, f"record {self.opcode} is cut short", **(details or {"source": "field beyond the body"}))
        part = self.body[self.at : self.at + n]
        self.at += n
        return part

    def number(self, kind: str) -> int:
        s = _NUMBER[kind]
        return s.unpack(self.take(s.size))[0]

    def string(self) -> str:
        try:
            return bytes(self.take(self.number("i"))).decode("utf-8")
        except UnicodeDecodeError as e:
            raise LogError("Parse", f"record {self.opcode}: text is not UTF-8", source=str(e)) from None

    def collection(self) -> _Cursor:
        return _Cursor(self.take(self.number("i")), self.opcode)

    def done(self) -> bool:
        return self.at == len(self.body)

    def field(self, kind: str):
        if kind in _NUMBER:
            return self.number(kind)
        if kind == "s":
            return self.string()
        if kind == "r":
            return bytes(self.take(len(self.body) - self.at))
        if kind in "BD":
            n = self.number("i" if kind == "B" else "q")
            what = {SCHEMA: "BadSchemaLength", CHUNK: "BadChunkLength", ATTACHMENT: "BadAttachmentLength"}.get(self.opcode, "Parse")
            return bytes(self.take(n, what, header=n, available=len(self.body) - self.at))
        inner, out = self.collection(), {}
        if kind == "p":
            if len(inner.body) % _PAIR.size:
                raise LogError("Parse", "message index entries have a broken length", source="collection length")
            return list(_PAIR.iter_unpack(inner.body))
        if kind == "n":
            if len(inner.body) % _ENTRY.size:
                raise LogError("Parse", f"record {self.opcode}: map has a broken length", source="collection length")
            return dict(_ENTRY.iter_unpack(inner.body))
        while not inner.done():
            key = inner.string()
            out[key] = inner.string()  # of a repeated key the last value stays
        return out


def parse(opcode: int, body) -> tuple:
    """The record of a body; opcodes that the format doesn't name give a Raw record."""
    if opcode not in LAYOUTS:
        return Raw(opcode, bytes(body))
    kind, layout = LAYOUTS[opcode]
    cursor = _Cursor(body, opcode)
    return kind(*[cursor.field(c) for c in layout])


def _string(text: str) -> bytes:
    raw = text.encode("utf-8")
    return _NUMBER["i"].pack(len(raw)) + raw


def _collection(parts: Iterator[bytes] | list[bytes]) -> bytes:
    raw = b"".join(parts)
    return _NUMBER["i"].pack(len(raw)) + raw


def _encode(kind: str, value) -> bytes:
    if kind in _NUMBER:
        return _NUMBER[kind].pack(value)
    if kind == "s":
        return _string(value)
    if kind == "m":
        return _collection([_string(k) + _string(v) for k, v in value.items()])
    if kind == "n":
        return _collection([_ENTRY.pack(k, v) for k, v in sorted(value.items())])
    if kind == "p":
        return _collection([np.array(value, dtype="<u8").tobytes()])
    if kind == "r":
        return value
    return _NUMBER["i" if kind == "B" else "q"].pack(len(value)) + value


_OPCODES = {kind: op for op, (kind, _) in LAYOUTS.items()}


def opcode_of(record: tuple) -> int:
    return record.opcode if isinstance(record, Raw) else _OPCODES[type(record)]


def body_of(record: tuple) -> bytes:
    if isinstance(record, Raw):
        return record.body
    return b"".join(_encode(k, v) for k, v in zip(LAYOUTS[_OPCODES[type(record)]][1], record))


def framed(opcode: int, body: bytes) -> bytes:
    return _PREFIX.pack(opcode, len(body)) + body


def encode(record: tuple) -> bytes:
    """Prefix and body of a record."""
    return framed(opcode_of(record), body_of(record))


def compress(codec: str, data: bytes, level: int | None = None, threads: int = 0) -> bytes:
    if codec == "":
        return data
    if codec == "lz4":
        return pa.Codec("lz4", compression_level=level or None).compress(data, asbytes=True)
    if codec == "zstd":
        import zstandard

        return zstandard.ZstdCompressor(level=level or 3, threads=threads).compress(data)
    raise LogError("UnsupportedCompression", compression=codec)


def decompress(codec: str, data: bytes, size: int) -> bytes:
    if codec not in CODECS:
        raise LogError("UnsupportedCompression", compression=codec)
    try:
        if codec == "":
            out = bytes(data)
        elif codec == "lz4":
            out = pa.Codec("lz4").decompress(data, decompressed_size=size, asbytes=True) if size else b""
        else:
            import zstandard

            out = zstandard.ZstdDecompressor().decompress(data, max_output_size=size) if size else b""
    except Exception as e:
        raise LogError("DecompressionError", str(e), description=str(e)) from None
    if len(out) != size:
        raise LogError("DecompressionError", "the chunk has another size than declared", description=f"{len(out)} of {size} bytes")
    return out


def checked(kind: str, saved: int, data: bytes) -> None:
    """Raises unless the stored CRC is absent (0) or right."""
    if saved and (found := zlib.crc32(data)) != saved:
        raise LogError(kind, "the stored checksum differs", saved=saved, calculated=found)


def expand(chunk: Chunk, check: bool = True) -> bytes:
    """The records of a chunk."""
    out = decompress(chunk.compression, chunk.data, chunk.uncompressed_size)
    if check:
        checked("BadChunkCrc", chunk.uncompressed_crc, out)
    return out


def walk(data, limit: int | None = None) -> Iterator[tuple[int, int, memoryview]]:
    """(offset, opcode, body) of the records in the bytes of a chunk."""
    view, at = memoryview(data), 0
    while at < len(view):
        if at + PREFIX > len(view):
            raise LogError("UnexpectedEoc", "a record prefix is cut short")
        opcode, n = _PREFIX.unpack_from(view, at)
        if limit is not None and n > limit:
            raise LogError("RecordTooLarge", opcode=opcode, len=n)
        if n > len(view) - at - PREFIX:
            raise LogError("UnexpectedEoc", "a record is cut short")
        yield at, opcode, view[at + PREFIX : at + PREFIX + n]
        at += PREFIX + n


def attachment_crc_ok(body) -> None:
    """Raises if an attachment's own checksum is present and wrong."""
    checked("BadAttachmentCrc", _NUMBER["i"].unpack(bytes(body[-4:]))[0], bytes(body[:-4]))


def data_offset(index: ChunkIndex) -> int:
    """Where a chunk's compressed bytes begin."""
    return index.chunk_start_offset + PREFIX + 40 + len(index.compression.encode("utf-8"))


def indexed_records(data: bytes) -> list[tuple[int, int, int]]:
    """(channel id, log time, offset) of a chunk's messages; offsets count every record of the chunk."""
    head = struct.Struct("<HIQ")
    return [(h[0], h[2], at) for at, opcode, body in walk(data) if opcode == MESSAGE for h in (head.unpack_from(body),)]
