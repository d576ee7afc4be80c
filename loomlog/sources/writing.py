"""Writing one recording to a file object."""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterable
from dataclasses import dataclass, fields, replace
from typing import BinaryIO

import numpy as np

from loomlog.sources import format as f
from loomlog.sources.errors import LogError

LIBRARY = "loomlog"
_TIMES = struct.Struct("<HIQQ")
U64 = 1 << 64

#: Errors raised before anything was written: the writer stays usable.
SAFE = frozenset({"InvalidSchemaId", "ConflictingSchemas", "UnknownSchema", "ConflictingChannels", "UnknownChannel"})


@dataclass(frozen=True)
class WriterOptions:
    """Layout of a recording. ``emit_summary`` sets the switches left at None; explicit ones win."""

    compression: str = "zstd"
    chunk_size: int | None = 1 << 20
    use_chunks: bool = True
    profile: str = ""
    library: str = LIBRARY
    emit_summary: bool | None = None
    emit_summary_offsets: bool | None = None
    emit_statistics: bool | None = None
    emit_message_indexes: bool | None = None
    emit_chunk_indexes: bool | None = None
    emit_attachment_indexes: bool | None = None
    emit_metadata_indexes: bool | None = None
    repeat_channels: bool | None = None
    repeat_schemas: bool | None = None
    chunk_crcs: bool = True
    data_crc: bool = True
    summary_crc: bool = True
    attachment_crcs: bool = True
    compression_level: int | None = None
    compression_threads: int = 0

    def __post_init__(self):
        if self.compression not in (*f.CODECS, "none"):
            raise LogError("UnsupportedCompression", compression=self.compression)

    @property
    def codec(self) -> str:
        return "" if self.compression == "none" else self.compression

    def emits(self, switch: str) -> bool:
        own = getattr(self, switch)
        if own is None and switch not in ("emit_summary_offsets", "emit_message_indexes"):
            own = self.emit_summary
        return True if own is None else own

    @staticmethod
    def of(options: dict[str, str]) -> WriterOptions:
        """From string options with names in any case, with or without underscores."""
        known = {x.name.replace("_", ""): x for x in fields(WriterOptions)}
        out = WriterOptions()
        for key, value in options.items():
            field = known.get(key.lower().replace("_", ""))
            if field is None:
                continue
            kind = str(field.type)
            text = str(value).strip()
            if "bool" in kind:
                parsed = None if text.lower() in ("", "null", "none") else text.lower() == "true"
            elif "int" in kind:
                parsed = None if text.lower() in ("", "null", "none") else int(text)
            else:
                parsed = text.lower() if field.name == "compression" else text
            out = replace(out, **{field.name: parsed})
        return out


@dataclass
class Summary:
    schemas: dict[int, f.Schema]
    channels: dict[int, f.Channel]
    statistics: f.Statistics | None
    chunk_indexes: list[f.ChunkIndex]
    attachment_indexes: list[f.AttachmentIndex]
    metadata_indexes: list[f.MetadataIndex]

    def records(self) -> Iterable[tuple]:
        """Channels, schemas, statistics, then chunk, attachment and metadata indexes."""
        yield from (self.channels[k] for k in sorted(self.channels))
        yield from (self.schemas[k] for k in sorted(self.schemas))
        if self.statistics:
            yield self.statistics
        yield from (*self.chunk_indexes, *self.attachment_indexes, *self.metadata_indexes)


class RecordingWriter:
    """Declarations, messages, attachments, metadata and private records into one recording.

    ``complete`` must be called: closing the file object alone leaves an unfinished recording.
    """

    def __init__(self, out: BinaryIO, options: WriterOptions | None = None):
        self.out, self.options = out, options or WriterOptions()
        self.at, self.crc = 0, 0
        self.schemas: dict[int, f.Schema] = {}
        self.channels: dict[int, f.Channel] = {}
        self.counts: dict[int, int] = {}
        self.times: tuple[int, int] | None = None
        self.chunk_indexes: list[f.ChunkIndex] = []
        self.attachment_indexes: list[f.AttachmentIndex] = []
        self.metadata_indexes: list[f.MetadataIndex] = []
        self.attachments = self.metadata = self.chunks = 0
        self.chunk: io.BytesIO | None = None
        self.summary: Summary | None = None
        self.part: tuple | None = None
        self.failed = False
        self._raw(f.MAGIC)
        self._raw(f.encode(f.Header(self.options.profile, self.options.library)))

    def _raw(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)
        if self.options.data_crc and self.summary is None:
            self.crc = zlib.crc32(data, self.crc)

    def _ready(self, attachment: bool = False) -> None:
        if self.failed:
            raise LogError("AttemptedWriteAfterFailure")
        if self.summary is not None:
            raise ValueError("the recording is complete")
        if (self.part is not None) != attachment:
            raise LogError("AttachmentNotInProgress") if attachment else ValueError("an attachment is in progress")

    def _record(self, data: bytes) -> None:
        """Into the open chunk, or the file where chunks are off."""
        if not self.options.use_chunks:
            self._raw(data)
            return
        if self.chunk is None:
            self.chunk, self.chunk_times, self.chunk_index = io.BytesIO(), None, {}
        self.chunk.write(data)

    def _chunk_full(self) -> None:
        if self.chunk is not None and self.options.chunk_size is not None and self.chunk.tell() > self.options.chunk_size:
            self._close_chunk()

    def flush(self) -> None:
        """Closes the open chunk."""
        self._ready()
        self._close_chunk()

    def _close_chunk(self) -> None:
        if self.chunk is None:
            return
        data, self.chunk = self.chunk.getvalue(), None
        start, end = self.chunk_times or (0, 0)
        packed = f.compress(self.options.codec, data, self.options.compression_level, self.options.compression_threads)
        offset = self.at
        self._raw(f.encode(f.Chunk(start, end, len(data), zlib.crc32(data) if self.options.chunk_crcs else 0, self.options.codec, packed)))
        length, offsets, first = self.at - offset, {}, self.at
        if self.options.emits("emit_message_indexes"):
            for channel in sorted(self.chunk_index):
                offsets[channel] = self.at
                self._raw(f.encode(f.MessageIndex(channel, self.chunk_index[channel])))
        self.chunks += 1
        self.chunk_indexes.append(f.ChunkIndex(start, end, offset, length, offsets, self.at - first, self.options.codec, len(packed), len(data)))

    def register_schema(self, name: str, encoding: str, data: bytes, id: int | None = None) -> int:
        """The schema's id; equal content without an id is registered once."""
        self._ready()
        if id is None:
            for s in self.schemas.values():
                if s[1:] == (name, encoding, data):
                    return s.id
            id = next((i for i in range(1, 1 << 16) if i not in self.schemas), 0)
            if not id:
                raise LogError("TooManySchemas")
        if id == 0:
            raise LogError("InvalidSchemaId")
        schema = f.Schema(id, name, encoding, data)
        if id in self.schemas:
            if self.schemas[id] != schema:
                raise LogError("ConflictingSchemas", name=name)
            return id
        self.schemas[id] = schema
        self._record(f.encode(schema))
        return id

    def register_channel(self, topic: str, encoding: str, schema_id: int = 0, metadata: dict[str, str] | None = None, id: int | None = None) -> int:
        """The channel's id; equal content without an id is registered once."""
        self._ready()
        metadata = dict(metadata or {})
        if schema_id and schema_id not in self.schemas:
            raise LogError("UnknownSchema", name=topic, schema_id=schema_id)
        if id is None:
            for c in self.channels.values():
                if c[1:] == (schema_id, topic, encoding, metadata):
                    return c.id
            id = next((i for i in range(1 << 16) if i not in self.channels), -1)
            if id < 0:
                raise LogError("TooManyChannels")
        channel = f.Channel(id, schema_id, topic, encoding, metadata)
        if id in self.channels:
            if self.channels[id] != channel:
                raise LogError("ConflictingChannels", name=topic)
            return id
        self.channels[id] = channel
        self._record(f.encode(channel))
        return id

    def write(self, channel_id: int, sequence: int, log_time: int, publish_time: int, data: bytes) -> None:
        self._ready()
        if channel_id not in self.channels:
            raise LogError("UnknownChannel", sequence=sequence, channel_id=channel_id)
        if not (0 <= log_time < U64 and 0 <= publish_time < U64 and 0 <= sequence < 1 << 32):
            raise ValueError("times are unsigned 64-bit, sequences unsigned 32-bit numbers")
        if self.options.use_chunks and self.chunk is None:
            self._record(b"")
        if self.options.use_chunks:
            self.chunk_index.setdefault(channel_id, []).append((log_time, self.chunk.tell()))
            a, b = self.chunk_times or (log_time, log_time)
            self.chunk_times = (min(a, log_time), max(b, log_time))
        self._record(f.framed(f.MESSAGE, _TIMES.pack(channel_id, sequence, log_time, publish_time) + data))
        a, b = self.times or (log_time, log_time)
        self.times = (min(a, log_time), max(b, log_time))
        self.counts[channel_id] = self.counts.get(channel_id, 0) + 1
        self._chunk_full()

    def write_encoded(self, channel_id: np.ndarray, log_time: np.ndarray, records: np.ndarray, at: np.ndarray) -> None:
        """Encoded messages of declared channels, with the offsets of the records; chunks end where single writes end them."""
        self._ready()
        for c, n in zip(*(x.tolist() for x in np.unique(channel_id, return_counts=True))):
            self.counts[c] = self.counts.get(c, 0) + n
        if len(log_time):
            low, high = int(log_time.min()), int(log_time.max())
            a, b = self.times or (low, high)
            self.times = (min(a, low), max(b, high))
        if not self.options.use_chunks:
            self._raw(records.tobytes())
            return
        i, n, size = 0, len(log_time), self.options.chunk_size
        while i < n:
            if self.chunk is None:
                self._record(b"")
            base = self.chunk.tell() - int(at[i])
            # A chunk ends with the record that takes it beyond its size.
            j = n if size is None else min(n, int(np.searchsorted(at[i + 1 :], size - base, "right")) + i + 1)
            own = channel_id[i:j]
            for c in np.unique(own).tolist():
                mine = np.flatnonzero(own == c) + i
                self.chunk_index.setdefault(c, []).extend(zip(log_time[mine].tolist(), (at[mine] + base).tolist()))
            low, high = int(log_time[i:j].min()), int(log_time[i:j].max())
            a, b = self.chunk_times or (low, high)
            self.chunk_times = (min(a, low), max(b, high))
            self.chunk.write(records[at[i] : at[j]].data)
            self._chunk_full()
            i = j

    def write_attachment(self, name: str, media_type: str, data: bytes, log_time: int = 0, create_time: int = 0) -> None:
        self.start_attachment(name, media_type, len(data), log_time, create_time)
        self.put_attachment(data)
        self.finish_attachment()

    def start_attachment(self, name: str, media_type: str, length: int, log_time: int = 0, create_time: int = 0) -> None:
        """An attachment in parts of exactly ``length`` bytes; nothing else may be written meanwhile."""
        self._ready()
        self.part = (name, media_type, length, log_time, create_time, bytearray())

    def put_attachment(self, data: bytes) -> None:
        self._ready(attachment=True)
        own = self.part[5]
        if len(own) + len(data) > self.part[2]:
            raise LogError("AttachmentTooLarge", excess=len(own) + len(data) - self.part[2], attachment_length=self.part[2])
        own += data

    def finish_attachment(self) -> None:
        self._ready(attachment=True)
        name, media_type, length, log_time, create_time, data = self.part
        if len(data) != length:
            raise LogError("AttachmentIncomplete", current=len(data), expected=length)
        self.part = None
        self._close_chunk()
        body = f.body_of(f.Attachment(log_time, create_time, name, media_type, bytes(data), 0))
        crc = zlib.crc32(body[:-4]) if self.options.attachment_crcs else 0
        offset = self.at
        self._raw(f.framed(f.ATTACHMENT, body[:-4] + crc.to_bytes(4, "little")))
        self.attachments += 1
        self.attachment_indexes.append(f.AttachmentIndex(offset, self.at - offset, log_time, create_time, length, name, media_type))

    def write_metadata(self, name: str, values: dict[str, str]) -> None:
        self._ready()
        self._close_chunk()
        offset = self.at
        self._raw(f.encode(f.Metadata(name, dict(values))))
        self.metadata += 1
        self.metadata_indexes.append(f.MetadataIndex(offset, self.at - offset, name))

    def write_private(self, opcode: int, body: bytes, in_chunks: bool = False) -> None:
        self._ready()
        if opcode < f.PRIVATE:
            raise LogError("PrivateRecordOpcodeIsReserved", opcode=opcode)
        if in_chunks and self.options.use_chunks:
            self._record(f.framed(opcode, body))
            self._chunk_full()
        else:
            self._close_chunk()
            self._raw(f.framed(opcode, body))

    def complete(self) -> Summary:
        """Ends the recording; the summary describes it even where summary records are off. May be called again."""
        if self.summary is not None:
            return self.summary
        self._ready()
        self._close_chunk()
        o = self.options
        start, end = self.times or (0, 0)
        statistics = f.Statistics(sum(self.counts.values()), len(self.schemas), len(self.channels), self.attachments, self.metadata, self.chunks, start, end, dict(self.counts))
        self._raw(f.encode(f.DataEnd(self.crc if o.data_crc else 0)))
        self.summary = Summary(self.schemas, self.channels, statistics, self.chunk_indexes, self.attachment_indexes, self.metadata_indexes)
        groups = [
            (f.SCHEMA, "repeat_schemas", [self.schemas[k] for k in sorted(self.schemas)]),
            (f.CHANNEL, "repeat_channels", [self.channels[k] for k in sorted(self.channels)]),
            (f.STATISTICS, "emit_statistics", [statistics]),
            (f.CHUNK_INDEX, "emit_chunk_indexes", self.chunk_indexes),
            (f.ATTACHMENT_INDEX, "emit_attachment_indexes", self.attachment_indexes),
            (f.METADATA_INDEX, "emit_metadata_indexes", self.metadata_indexes),
        ]
        first, tail, offsets = self.at, b"", []
        for opcode, switch, records in groups:
            if records and o.emits(switch):
                part = b"".join(map(f.encode, records))
                offsets.append(f.SummaryOffset(opcode, first + len(tail), len(part)))
                tail += part
        start_of_offsets = 0
        if offsets and o.emits("emit_summary_offsets"):
            start_of_offsets = first + len(tail)
            tail += b"".join(map(f.encode, offsets))
        summary_start = first if tail else 0
        head = tail + f._PREFIX.pack(f.FOOTER, f.FOOTER_BODY) + struct.pack("<QQ", summary_start, start_of_offsets)
        self._raw(head + struct.pack("<I", zlib.crc32(head) if o.summary_crc else 0) + f.MAGIC)
        return self.summary
