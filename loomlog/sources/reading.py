"""Reading one recording: sequential scan with checks, summary, index coverage, records at an offset."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import BinaryIO

from loomlog.sources import format as f
from loomlog.sources.errors import LogError
from loomlog.sources.writing import Summary

_U16U32U64U64 = struct.Struct("<HIQQ")


@dataclass(frozen=True)
class ReaderOptions:
    """Optional checks are off; ``strict`` turns the integrity checks on. Body and reference checks always run."""

    chunk_crcs: bool = False
    data_crc: bool = False
    summary_crc: bool = False
    attachment_crcs: bool = False
    after_end: bool = False
    record_limit: int | None = None
    start_offset: int = 0

    @staticmethod
    def strict(record_limit: int | None = None, start_offset: int = 0) -> ReaderOptions:
        return ReaderOptions(True, True, True, True, True, record_limit, start_offset)


@dataclass
class Seen:
    """What the data section has declared so far, checked as it goes."""

    schemas: dict[int, f.Schema] = field(default_factory=dict)
    channels: dict[int, f.Channel] = field(default_factory=dict)

    def see(self, record: tuple) -> None:
        if isinstance(record, f.Schema):
            if record.id == 0:
                raise LogError("InvalidSchemaId")
            if self.schemas.setdefault(record.id, record) != record:
                raise LogError("ConflictingSchemas", name=record.name)
        elif isinstance(record, f.Channel):
            if record.schema_id and record.schema_id not in self.schemas:
                raise LogError("UnknownSchema", name=record.topic, schema_id=record.schema_id)
            if self.channels.setdefault(record.id, record) != record:
                raise LogError("ConflictingChannels", name=record.topic)

    def channel_of(self, channel_id: int, sequence: int) -> f.Channel:
        if channel_id not in self.channels:
            raise LogError("UnknownChannel", sequence=sequence, channel_id=channel_id)
        return self.channels[channel_id]


@dataclass
class Located:
    """A record and where it stands: offset of its top-level record, number of the chunk (-1: none), number in it."""

    offset: int
    chunk: int
    index: int
    opcode: int
    body: memoryview
    in_summary: bool

    @property
    def ordinal(self) -> int:
        """File order, unique in a recording."""
        return (self.offset << 24) | self.index


def _exactly(data: BinaryIO, n: int) -> bytes:
    out = data.read(n)
    if len(out) < n:
        raise LogError("UnexpectedEof", "the input ends inside a record")
    return out


def scan(data: BinaryIO, options: ReaderOptions = ReaderOptions(), expand: bool = True) -> Iterator[Located]:
    """All records in file order; with ``expand`` those of chunks in place of the chunks."""
    data.seek(options.start_offset)
    if _exactly(data, len(f.MAGIC)) != f.MAGIC:
        raise LogError("BadMagic", "the recording doesn't begin with its magic")
    at, crc, chunk_no, in_summary = len(f.MAGIC), zlib.crc32(f.MAGIC), 0, False
    summary_crc = 0
    while True:
        prefix = _exactly(data, f.PREFIX)
        opcode, n = f._PREFIX.unpack(prefix)
        if options.record_limit is not None and n > options.record_limit:
            raise LogError("RecordTooLarge", opcode=opcode, len=n)
        body = memoryview(_exactly(data, n))
        if opcode == f.DATA_END:
            if options.data_crc and (saved := f.parse(opcode, body).data_section_crc) and saved != crc:
                raise LogError("BadDataCrc", saved=saved, calculated=crc)
        elif not in_summary:
            crc = zlib.crc32(body, zlib.crc32(prefix, crc))
        elif opcode != f.FOOTER:
            summary_crc = zlib.crc32(body, zlib.crc32(prefix, summary_crc))
        if opcode == f.ATTACHMENT and options.attachment_crcs:
            f.attachment_crc_ok(body)
        if opcode == f.CHUNK and expand:
            records = f.expand(f.parse(opcode, body), options.chunk_crcs)
            for i, (_, inner, part) in enumerate(f.walk(records, options.record_limit)):
                yield Located(at, chunk_no, i, inner, part, in_summary)
        else:
            yield Located(at, chunk_no if opcode == f.CHUNK else -1, 0, opcode, body, in_summary)
        chunk_no += opcode == f.CHUNK
        in_summary |= opcode == f.DATA_END
        at += f.PREFIX + n
        if opcode == f.FOOTER:
            if n != f.FOOTER_BODY:
                raise LogError("BadFooter")
            saved = f.parse(opcode, body).summary_crc
            found = zlib.crc32(body[:16], zlib.crc32(prefix, summary_crc))
            if options.summary_crc and saved and saved != found:
                raise LogError("BadSummaryCrc", saved=saved, calculated=found)
            if _exactly(data, len(f.MAGIC)) != f.MAGIC:
                raise LogError("BadMagic", "the recording doesn't end with its magic")
            if options.after_end and data.read(1):
                raise LogError("BytesAfterEndMagic")
            return


def checked_scan(data: BinaryIO, options: ReaderOptions = ReaderOptions()) -> Iterator[tuple[Located, tuple | None, Seen]]:
    """The expanded scan with bodies parsed and references checked against the data section alone."""
    seen = Seen()
    for where in scan(data, options):
        if where.opcode == f.MESSAGE:
            if len(where.body) < _U16U32U64U64.size:
                raise LogError("Parse", "a message header is cut short", source="field beyond the body")
            if not where.in_summary:
                seen.channel_of(*_U16U32U64U64.unpack_from(where.body)[:2])
            yield where, None, seen
            continue
        record = f.parse(where.opcode, where.body)
        if not where.in_summary:
            seen.see(record)
        yield where, record, seen


def message_of(body) -> f.Message:
    return f.Message(*_U16U32U64U64.unpack_from(body), bytes(body[_U16U32U64U64.size :]))


def read_footer(data: BinaryIO, start: int = 0) -> f.Footer:
    size = data.seek(0, 2)
    tail = f.PREFIX + f.FOOTER_BODY + len(f.MAGIC)
    if size - start < tail + len(f.MAGIC):
        raise LogError("UnexpectedEof", "the input is shorter than an empty recording")
    data.seek(size - tail)
    raw = _exactly(data, tail)
    if raw[-len(f.MAGIC) :] != f.MAGIC:
        raise LogError("BadMagic", "the recording doesn't end with its magic")
    opcode, n = f._PREFIX.unpack_from(raw)
    if opcode != f.FOOTER or n != f.FOOTER_BODY:
        raise LogError("BadFooter")
    return f.parse(opcode, raw[f.PREFIX : f.PREFIX + n])


def read_summary(data: BinaryIO, start: int = 0, declarations: bool = True) -> Summary | None:
    """The summary, or None without one. Channels repeated without their schemas are resolved by a scan."""
    footer = read_footer(data, start)
    if not footer.summary_start:
        return None
    out = Summary({}, {}, None, [], [], [])
    data.seek(start + footer.summary_start)
    while True:
        opcode, n = f._PREFIX.unpack(_exactly(data, f.PREFIX))
        if opcode == f.FOOTER:
            break
        record = f.parse(opcode, _exactly(data, n))
        if opcode == f.SCHEMA:
            out.schemas[record.id] = record
        elif opcode == f.CHANNEL:
            out.channels[record.id] = record
        elif opcode == f.STATISTICS:
            out.statistics = record
        elif opcode == f.CHUNK_INDEX:
            out.chunk_indexes.append(record)
        elif opcode == f.ATTACHMENT_INDEX:
            out.attachment_indexes.append(record)
        elif opcode == f.METADATA_INDEX:
            out.metadata_indexes.append(record)
    missing = [c for c in out.channels.values() if c.schema_id and c.schema_id not in out.schemas]
    if missing and declarations:
        found = {}
        for where, record, _ in checked_scan(data, ReaderOptions(start_offset=start)):
            if isinstance(record, f.Schema) and not where.in_summary:
                found[record.id] = record
        for c in missing:
            if c.schema_id not in found:
                raise LogError("UnknownSchema", name=c.topic, schema_id=c.schema_id)
    return out


def index_usable(data: BinaryIO, summary: Summary | None, start: int = 0) -> bool:
    """Whether chunk indexes cover all messages. Indexes that contradict the file are an error, not a fallback."""
    if summary is None or not summary.chunk_indexes or not summary.channels:
        return False
    if summary.statistics is None or summary.statistics.chunk_count != len(summary.chunk_indexes):
        return False
    if any(c.schema_id and c.schema_id not in summary.schemas for c in summary.channels.values()):
        return False
    return _tiled(data, read_footer(data, start).summary_start, summary, start)


def _tiled(data: BinaryIO, end: int, summary: Summary, start: int) -> bool:
    """Whether the indexed records leave no message beside them. Only what no index names is read, record by record."""
    spans = [(i.chunk_start_offset, i.chunk_length + i.message_index_length) for i in summary.chunk_indexes]
    spans = sorted(spans + [(i.offset, i.length) for i in (*summary.attachment_indexes, *summary.metadata_indexes)])
    at, k = len(f.MAGIC), 0
    while at < end:
        if k < len(spans) and spans[k][0] <= at:
            if spans[k][0] < at:
                raise LogError("BadIndex", "an index points into another record")
            at += spans[k][1]
            k += 1
            continue
        data.seek(start + at)
        opcode, n = f._PREFIX.unpack(_exactly(data, f.PREFIX))
        if opcode == f.MESSAGE:
            return False
        if opcode == f.CHUNK:
            raise LogError("BadIndex", "a chunk index points to something else")
        if opcode in (f.DATA_END, f.FOOTER):
            break
        at += f.PREFIX + n
    if k < len(spans):
        raise LogError("BadIndex", "an index points beyond the data")
    return True


def record_at(data: BinaryIO, offset: int, start: int = 0, limit: int | None = None) -> tuple[int, bytes]:
    """Opcode and body of the record at an offset from the recording's origin."""
    data.seek(start + offset)
    opcode, n = f._PREFIX.unpack(_exactly(data, f.PREFIX))
    if limit is not None and n > limit:
        raise LogError("RecordTooLarge", opcode=opcode, len=n)
    return opcode, _exactly(data, n)


def chunk_at(data: BinaryIO, index: f.ChunkIndex, start: int = 0) -> f.Chunk:
    opcode, body = record_at(data, index.chunk_start_offset, start)
    if opcode != f.CHUNK or len(body) + f.PREFIX != index.chunk_length:
        raise LogError("BadIndex", "a chunk index points to something else")
    return f.parse(opcode, body)


def validate(data: BinaryIO, options: ReaderOptions | None = None) -> int:
    """Records (not messages) of a strict scan; raises the first failure."""
    return sum(1 for _ in checked_scan(data, options or ReaderOptions.strict()))


def recover(data: BinaryIO, start: int = 0) -> Iterator[tuple[Located, f.Message, f.Channel] | LogError]:
    """Messages of the valid prefix in file order, then the error that ended it, if any. I/O errors propagate."""
    scan_ = checked_scan(data, ReaderOptions.strict(start_offset=start))
    while True:
        try:
            where, _, seen = next(scan_)
        except StopIteration:
            return
        except LogError as e:
            yield e
            return
        if where.opcode == f.MESSAGE and not where.in_summary:
            m = message_of(where.body)
            yield where, m, seen.channels[m.channel_id]
