"""The ``messagelog`` data source: tables of recordings as DataFrames, recordings as a sink, batch and streaming.

A recording whose chunk indexes cover all its messages is read by groups of chunks, those outside the asked times and
topics left out; any other recording is one partition. Messages of chunks are decoded by columns (columnar.py), the rest
row by row; all rows leave as Arrow batches.
"""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, DataSourceStreamReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

from loomlog.sources import columnar, files, model
from loomlog.sources import format as f
from loomlog.sources import reading as r
from loomlog.sources.errors import LogError
from loomlog.sources.writing import SAFE, RecordingWriter, WriterOptions

NAME = "messagelog"
BATCH_ROWS, BATCH_BYTES, GROUP_BYTES = 4096, 8 << 20, 16 << 20
#: Beginnings of the names of the sink's side files: what each job wrote, and the rows that it put aside.
REPORT, REJECTS = "_report-", "_rejects-"
#: Columns of a message row that say which channel it belongs to.
ABOUT = ("channel_id", "topic", "message_encoding", "schema_id", "schema_name", "schema_encoding", "schema_data")
#: Recordings that the driver plans chunk by chunk; where there are more, each is a partition and plans itself.
PLANNED = 512
#: Growing recordings that a worker remembers at most: how far each was read, its chunks so far and its declarations.
MAX_FOLLOWED = 64
_FOLLOWED: dict[tuple[str, int], tuple[int, int, r.Seen]] = {}


def _flag(options: dict, name: str, default: bool) -> bool:
    return str(options.get(name.lower(), default)).lower() == "true"


@dataclass(frozen=True)
class Want:
    """What is asked of the source, from its options (names without regard to case)."""

    table: str = "messages"
    topics: frozenset[str] | None = None
    start: int | None = None
    end: int | None = None
    payload: bool = True
    access: str = "auto"
    mode: str = "strict"
    u64: str = "long"
    expand: bool = True
    unknown_channels: str = "error"
    reading: r.ReaderOptions = r.ReaderOptions()
    offsets: tuple[int, ...] | None = None
    chunk_starts: tuple[int, ...] | None = None
    mapped: bool = False

    @staticmethod
    def of(options: dict[str, str]) -> Want:
        o = {k.lower(): v for k, v in options.items()}
        topics = None
        if o.get("topic") is not None and o.get("topics") is not None:
            raise ValueError("topic and topics exclude each other")
        if o.get("topic") is not None:
            topics = frozenset([o["topic"]])
        elif o.get("topics") is not None:
            topics = frozenset(json.loads(o["topics"]))
        start, end = (int(o[k]) if o.get(k) not in (None, "") else None for k in ("starttime", "endtime"))
        if start is not None and end is not None and start > end:
            raise ValueError("startTime is after endTime")
        limit = int(o["recordlengthlimit"]) if o.get("recordlengthlimit") else None
        origin = int(o.get("startoffset", 0))
        if _flag(o, "strict", False):
            reading = r.ReaderOptions.strict(limit, origin)
        else:
            reading = r.ReaderOptions(*(_flag(o, k, False) for k in ("validateChunkCrcs", "validateDataSectionCrc", "validateSummarySectionCrc", "validateAttachmentCrcs", "checkFinishesAfterEndMagic")), limit, origin)
        numbers = lambda k: tuple(json.loads(o[k])) if o.get(k) else None
        return Want(o.get("table", "messages"), topics, start, end, _flag(o, "payload", True), o.get("access", "auto"), o.get("mode", "strict"), o.get("u64", "long"), _flag(o, "expandChunks", True), o.get("unknownchannels", "error"), reading, numbers("offsets"), numbers("chunkstarts"), _flag(o, "mapped", False))

    def takes(self, topic: str | None, log_time: int) -> bool:
        return (self.topics is None or topic in self.topics) and (self.start is None or log_time >= self.start) and (self.end is None or log_time < self.end)


@dataclass
class Part(InputPartition):
    """A whole recording (chunks is None), some of its chunks, (offset, number) of each, or of a growing one the records
    that end in a span of bytes: behind the first position, at the second one at the latest."""

    path: str
    chunks: list[tuple[int, int]] | None = None
    span: tuple[int, int] | None = None

    def __init__(self, path: str, chunks: list[tuple[int, int]] | None = None, span: tuple[int, int] | None = None):
        self.path, self.chunks, self.span = path, chunks, span


class Batches:
    """Collects rows into Arrow batches bounded by rows and bytes."""

    def __init__(self, schema):
        self.schema, self.rows, self.size = to_arrow_schema(schema), [], 0

    def add(self, row: tuple, size: int = 0) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += size
        if len(self.rows) >= BATCH_ROWS or self.size >= BATCH_BYTES:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = []
            for i, field in enumerate(self.schema):
                values = [x[i] for x in self.rows]
                if pa.types.is_map(field.type):
                    values = [None if v is None else list(v.items()) for v in values]
                columns.append(pa.array(values, type=field.type))
            yield pa.RecordBatch.from_arrays(columns, schema=self.schema)
            self.rows, self.size = [], 0


def _u64(value: int, want: Want):
    if want.u64 == "decimal":
        from decimal import Decimal

        return Decimal(value)
    if value >= 1 << 63:
        raise LogError("Binding", "a 64-bit number doesn't fit a BIGINT; read with u64=decimal", resource="u64", limit=(1 << 63) - 1, requested=value)
    return value


def _times(values: np.ndarray, want: Want) -> pa.Array:
    if want.u64 == "decimal":
        return pa.array([_u64(x, want) for x in values.tolist()], type=pa.decimal128(20, 0))
    if len(values) and values.max() >= np.uint64(1 << 63):
        _u64(int(values.max()), want)
    return pa.array(values.astype(np.int64))


class LogReader(DataSourceReader):
    def __init__(self, schema, options: dict[str, str]):
        self.fields, self.want = schema, Want.of(options)
        self.path = options.get("path")
        if not self.path:
            raise ValueError("a path is needed")
        if self.want.table not in model.TABLES:
            raise ValueError(f"unknown table {self.want.table!r}")

    # -- planning ---------------------------------------------------------------------------------------------------
    def partitions(self) -> list[Part]:
        """Up to PLANNED recordings are planned here, from their footers and summaries; more are planned in their tasks."""
        paths = files.expand(self.path)
        if len(paths) > PLANNED:
            return [Part(path) for path in paths]
        with ThreadPoolExecutor(min(16, max(1, len(paths)))) as pool:
            return [p for parts in pool.map(self.plan, paths) for p in parts]

    def plan(self, path: str, opened=None) -> list[Part]:
        """Groups of chunks for messages of an indexed recording, else the whole."""
        w = self.want
        if w.table != "messages" or w.mode == "recover" or w.access == "scan" or w.unknown_channels != "error":
            if w.access == "indexed":
                raise LogError("Binding", "only messages are read by index", resource="access")
            return [Part(path)]
        linear = w.reading != r.ReaderOptions(record_limit=w.reading.record_limit, start_offset=w.reading.start_offset)
        if linear and w.access == "indexed":
            raise ValueError("indexed access excludes the checks of a linear scan")
        with nullcontext(opened) if opened is not None else files.opened(path) as data:
            try:
                summary = None if linear else r.read_summary(data, w.reading.start_offset, declarations=False)
                usable = r.index_usable(data, summary, w.reading.start_offset)
            except LogError as e:
                if w.access == "indexed" or e.kind == "BadIndex":
                    raise
                usable = False  # the scan reports what is wrong, in its order
        if not usable:
            if w.access == "indexed":
                raise LogError("Binding", "the recording has no usable chunk indexes", resource="index")
            return [Part(path)]
        ids = None if w.topics is None else {c.id for c in summary.channels.values() if c.topic in w.topics}
        out, group, size = [], [], 0
        order = {x.chunk_start_offset: i for i, x in enumerate(sorted(summary.chunk_indexes, key=lambda x: x.chunk_start_offset))}
        for index in sorted(summary.chunk_indexes, key=lambda x: x.chunk_start_offset):
            if w.start is not None and index.end_time < w.start or w.end is not None and index.start_time >= w.end:
                continue
            if ids is not None and (not ids or index.message_index_offsets and not ids & index.message_index_offsets.keys()):
                continue
            if w.chunk_starts is not None and index.chunk_start_offset not in w.chunk_starts:
                continue
            group.append((index.chunk_start_offset, order[index.chunk_start_offset]))
            size += index.uncompressed_size
            if size >= GROUP_BYTES:
                out.append(Part(path, group))
                group, size = [], 0
        return [*out, Part(path, group)] if group else out

    # -- rows -------------------------------------------------------------------------------------------------------
    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        if partition is None:  # Spark reads one empty partition where the plan has none
            return
        with files.opened(partition.path, self.want.mapped) as data:
            yield from self.batches(partition, data)

    def batches(self, part: Part, data) -> Iterator[pa.RecordBatch]:
        w = self.want
        if w.table == "messages" and w.mode != "recover" and w.unknown_channels != "keep":
            if part.chunks is None and w.access != "scan":
                groups = self.plan(part.path, data)
                if any(p.chunks is None for p in groups):
                    yield from self._scanned(part, data)
                for p in groups:
                    if p.chunks is not None:
                        yield from self._indexed(p, data)
            elif part.chunks is not None:
                yield from self._indexed(part, data)
            else:
                yield from self._scanned(part, data)
            return
        out = Batches(self.fields)
        for row, size in getattr(self, f"_{w.table}")(part, data):
            yield from out.add(row, size)
        yield from out.flush()

    def _indexed(self, part: Part, data) -> Iterator[pa.RecordBatch]:
        """Messages of the part's chunks; the summary declares their channels."""
        w = self.want
        summary = r.read_summary(data, w.reading.start_offset, declarations=False)
        indexes = {i.chunk_start_offset: i for i in summary.chunk_indexes}
        for offset, number in part.chunks:
            records = columnar.Records(f.expand(r.chunk_at(data, indexes[offset], w.reading.start_offset), False), w.reading.record_limit)
            self._declared(records, slice(None), summary.channels)
            yield from self._columns(part.path, number, offset, records, summary.channels)

    def _scanned(self, part: Part, data) -> Iterator[pa.RecordBatch]:
        """Messages in file order, every record checked; those of a chunk go by columns."""
        w, rows, seen = self.want, Batches(self.fields), r.Seen()
        for where in r.scan(data, w.reading, False):
            yield from self._taken(part.path, where, rows, seen)
        yield from rows.flush()

    def _followed(self, part: Part, data) -> Iterator[pa.RecordBatch]:
        """Messages of the complete records in the part's span. Of records before it only declarations are taken, and
        chunks, which may hold some; what this worker has seen of the recording before is not read again. A record that
        the span cuts belongs to a later one; the summary holds no messages, so its checks are left to a scan."""
        origin, rows = self.want.reading.start_offset, Batches(self.fields)
        a, b = (x - origin for x in part.span)
        key = (part.path, origin)
        at, chunk, seen = _FOLLOWED.pop(key, (0, 0, None))
        if seen is None or at > a:
            if b < len(f.MAGIC):
                return
            data.seek(origin)
            if data.read(len(f.MAGIC)) != f.MAGIC:
                raise LogError("BadMagic", "the recording doesn't begin with its magic")
            at, chunk, seen = len(f.MAGIC), 0, r.Seen()
        while at + f.PREFIX <= b:
            data.seek(origin + at)
            opcode, n = f._PREFIX.unpack(data.read(f.PREFIX))
            end = at + f.PREFIX + n
            if self.want.reading.record_limit is not None and n > self.want.reading.record_limit:
                raise LogError("RecordTooLarge", opcode=opcode, len=n)
            if end > b or opcode == f.DATA_END:
                break
            if end > a or opcode in (f.CHUNK, f.SCHEMA, f.CHANNEL):
                where = r.Located(at, chunk if opcode == f.CHUNK else -1, 0, opcode, memoryview(data.read(n)), False)
                yield from self._taken(part.path, where, rows, seen, end > a)
            chunk += opcode == f.CHUNK
            at = end
        yield from rows.flush()
        if len(_FOLLOWED) >= MAX_FOLLOWED:
            del _FOLLOWED[next(iter(_FOLLOWED))]
        _FOLLOWED[key] = at, chunk, seen

    def _taken(self, path: str, where: r.Located, rows: Batches, seen: r.Seen, emit: bool = True) -> Iterator[pa.RecordBatch]:
        """A top-level record checked, its declarations seen, its messages (with ``emit``) given or added to ``rows``."""
        w = self.want
        if where.opcode == f.CHUNK:
            records = columnar.Records(f.expand(f.parse(f.CHUNK, where.body), w.reading.chunk_crcs), w.reading.record_limit)
            first = 0  # messages up to here have been checked
            for i in np.flatnonzero(records.opcodes != f.MESSAGE).tolist():
                record, last = f.parse(int(records.opcodes[i]), records.body(i)), int(np.searchsorted(records.where, i))
                if not where.in_summary:
                    self._declared(records, slice(first, last), seen.channels)
                    seen.see(record)
                first = last
            if not where.in_summary:
                self._declared(records, slice(first, None), seen.channels)
                if emit:
                    yield from rows.flush()
                    yield from self._columns(path, where.chunk, where.offset, records, seen.channels)
        elif where.opcode == f.MESSAGE:
            m = r.message_of(where.body)
            if not where.in_summary and w.takes((c := seen.channel_of(m.channel_id, m.sequence)).topic, m.log_time):
                yield from rows.add(*self._message(path, -1, where.ordinal, m, c))
        else:
            record = f.parse(where.opcode, where.body)
            if not where.in_summary:
                seen.see(record)

    @staticmethod
    def _declared(records: columnar.Records, some: slice, channels: dict[int, f.Channel]) -> None:
        heads = records.heads[some]
        if set(np.unique(heads["channel_id"]).tolist()) - channels.keys():
            bad = next(h for h in heads if int(h["channel_id"]) not in channels)
            raise LogError("UnknownChannel", sequence=int(bad["sequence"]), channel_id=int(bad["channel_id"]))

    def _columns(self, path: str, chunk: int, offset: int, records: columnar.Records, channels: dict[int, f.Channel]) -> Iterator[pa.RecordBatch]:
        """The wanted messages of a chunk as batches."""
        w, h = self.want, records.heads
        ids, own = np.unique(h["channel_id"], return_inverse=True)
        about = [channels[i] for i in ids.tolist()]
        mask = np.ones(len(h), dtype=bool)
        if w.topics is not None:
            mask &= np.array([c.topic in w.topics for c in about], dtype=bool)[own]
        if w.start is not None and w.start > 0:
            mask &= h["log_time"] >= np.uint64(w.start) if w.start < 1 << 64 else False
        if w.end is not None and w.end < 1 << 64:
            mask &= h["log_time"] < np.uint64(max(0, w.end))
        chosen = np.flatnonzero(mask)
        before = np.append(0, np.cumsum(records.sizes()[chosen] + columnar.HEAD.itemsize))
        schema = to_arrow_schema(self.fields)
        a = 0
        while a < len(chosen):
            b = max(a + 1, int(np.searchsorted(before, before[a] + BATCH_BYTES, "right")) - 1)
            some = chosen[a:b]
            head, mine = h[some], pa.array(own[some])
            of = lambda name: pa.array([getattr(c, name) for c in about], type=schema.field(name).type).take(mine)
            columns = {
                "path": pa.repeat(pa.scalar(path, pa.string()), b - a), "chunk_ordinal": pa.repeat(pa.scalar(chunk, pa.int32()), b - a), "record_ordinal": pa.array((offset << 24) | records.where[some]),
                "channel_id": pa.array(head["channel_id"].astype(np.int32)), "sequence": pa.array(head["sequence"].astype(np.int64)), "log_time": _times(head["log_time"], w), "publish_time": _times(head["publish_time"], w),
                "topic": of("topic"), "message_encoding": of("message_encoding"), "schema_id": of("schema_id"), "data": records.payloads(some) if w.payload else pa.nulls(b - a, pa.binary()),
            }
            yield pa.RecordBatch.from_arrays([columns[x.name] for x in schema], schema=schema)
            a = b

    def _message(self, path: str, chunk: int, ordinal: int, m: f.Message, c: f.Channel | None) -> tuple[tuple, int]:
        w = self.want
        about = (c.topic, c.message_encoding, c.schema_id) if c else (None, None, None)
        return (path, chunk, ordinal, m.channel_id, m.sequence, _u64(m.log_time, w), _u64(m.publish_time, w), *about, m.data if w.payload else None), len(m.data) if w.payload else 0

    def _messages(self, part: Part, data) -> Iterator[tuple[tuple, int]]:
        """Row by row: the valid prefix, or all messages whether their channels are declared or not."""
        w = self.want
        if w.mode == "recover":
            for found in r.recover(data, w.reading.start_offset):
                if isinstance(found, LogError):
                    return
                where, m, c = found
                if w.takes(c.topic, m.log_time):
                    yield self._message(part.path, where.chunk, where.ordinal, m, c)
            return
        seen = r.Seen()
        for where in r.scan(data, w.reading):
            if where.opcode == f.CHANNEL and not where.in_summary:
                record = f.parse(f.CHANNEL, where.body)
                seen.channels.setdefault(record.id, record)
            elif where.opcode == f.MESSAGE:
                m = r.message_of(where.body)
                c = seen.channels.get(m.channel_id)
                if w.takes(c.topic if c else None, m.log_time):
                    yield self._message(part.path, where.chunk, where.ordinal, m, c)

    def _typed(self, part: Part, data, kind: type) -> Iterator[tuple[r.Located, tuple]]:
        w = self.want
        if w.offsets is not None:
            for offset in w.offsets:
                opcode, body = r.record_at(data, offset, w.reading.start_offset, w.reading.record_limit)
                if kind is not f.LAYOUTS.get(opcode, (f.Raw,))[0]:
                    raise LogError("BadIndex", "an index points to something else")
                yield r.Located(offset, -1, 0, opcode, memoryview(body), False), f.parse(opcode, body)
            return
        if w.unknown_channels == "keep":  # the records alone, without the checks of references
            for where in r.scan(data, w.reading):
                if where.opcode in f.LAYOUTS and f.LAYOUTS[where.opcode][0] is kind and not where.in_summary:
                    yield where, f.parse(where.opcode, where.body)
            return
        for where, record, _ in r.checked_scan(data, w.reading):
            if isinstance(record, kind) and not where.in_summary:
                yield where, record

    def _at(self, part: Part, where: r.Located) -> tuple:
        return part.path, where.chunk, where.ordinal

    def _schemas(self, part, data):
        for where, s in self._typed(part, data, f.Schema):
            yield (*self._at(part, where), *s), len(s.data)

    def _channels(self, part, data):
        for where, c in self._typed(part, data, f.Channel):
            yield (*self._at(part, where), *c), 0

    def _metadata(self, part, data):
        for where, m in self._typed(part, data, f.Metadata):
            yield (*self._at(part, where), *m), 0

    def _attachments(self, part, data):
        w = self.want
        for where, a in self._typed(part, data, f.Attachment):
            yield (*self._at(part, where), _u64(a.log_time, w), _u64(a.create_time, w), a.name, a.media_type, a.data if w.payload else None, a.crc), len(a.data)

    def _records(self, part, data):
        w = self.want
        if w.offsets is not None:
            for offset in w.offsets:
                opcode, body = r.record_at(data, offset, w.reading.start_offset, w.reading.record_limit)
                yield (part.path, -1, offset << 24, opcode, False, body), len(body)
            return
        found = ((x, None, None) for x in r.scan(data, w.reading, False)) if not w.expand else r.checked_scan(data, w.reading)
        for where, _, _ in found:
            yield (*self._at(part, where), where.opcode, where.in_summary, bytes(where.body)), len(where.body)

    def _top(self, part, data, opcode: int):
        for where in r.scan(data, self.want.reading, False):
            if where.opcode == opcode:
                yield where, f.parse(opcode, where.body)

    def _chunks(self, part, data):
        w = self.want
        for where, c in self._top(part, data, f.CHUNK):
            yield (*self._at(part, where), _u64(c.start_time, w), _u64(c.end_time, w), *c[2:]), len(c.data)

    def _header(self, part, data):
        for where, h in self._top(part, data, f.HEADER):
            yield (*self._at(part, where), *h), 0
            return

    def _footer(self, part, data):
        footer = r.read_footer(data, self.want.reading.start_offset)
        yield (part.path, -1, None, *footer), 0

    def _summary_offsets(self, part, data):
        for where, s in self._top(part, data, f.SUMMARY_OFFSET):
            yield (*self._at(part, where), *s), 0

    def _summary(self, data):
        return r.read_summary(data, self.want.reading.start_offset)

    def _statistics(self, part, data):
        s = self._summary(data)
        if s and s.statistics:
            t = s.statistics
            yield (part.path, *t[:6], _u64(t.message_start_time, self.want), _u64(t.message_end_time, self.want), t.channel_message_counts), 0

    def _chunk_index(self, part, data):
        for i in (self._summary(data) or r.Summary({}, {}, None, [], [], [])).chunk_indexes:
            yield (part.path, _u64(i.start_time, self.want), _u64(i.end_time, self.want), *i[2:]), 0

    def _message_index(self, part, data):
        """A row for each entry, by chunk and channel; a channel without entries has one row with nulls."""
        s = self._summary(data)
        for i in sorted(s.chunk_indexes if s else [], key=lambda i: i.chunk_start_offset):
            if self.want.chunk_starts is not None and i.chunk_start_offset not in self.want.chunk_starts:
                continue
            for channel, offset in sorted(i.message_index_offsets.items()):
                opcode, body = r.record_at(data, offset, self.want.reading.start_offset)
                if opcode != f.MESSAGE_INDEX or (found := f.parse(opcode, body)).channel_id != channel:
                    raise LogError("BadIndex", "a chunk index points to something else")
                for log_time, at in found.entries or [(None, None)]:
                    yield (part.path, i.chunk_start_offset, channel, None if log_time is None else _u64(log_time, self.want), at), 0

    def _attachment_index(self, part, data):
        for a in (self._summary(data) or r.Summary({}, {}, None, [], [], [])).attachment_indexes:
            yield (part.path, a.offset, a.length, _u64(a.log_time, self.want), _u64(a.create_time, self.want), *a[4:]), 0

    def _metadata_index(self, part, data):
        for m in (self._summary(data) or r.Summary({}, {}, None, [], [], [])).metadata_indexes:
            yield (part.path, *m), 0

    def _validation(self, part, data):
        """One row a recording; only strict scans of the whole file are called validation."""
        records = messages = 0
        strict = r.ReaderOptions.strict(self.want.reading.record_limit, self.want.reading.start_offset)
        try:
            for where, _, _ in r.checked_scan(data, strict):
                records += 1
                messages += where.opcode == f.MESSAGE and not where.in_summary
            yield (part.path, True, records, messages, None, None, "StrictFullScan"), 0
        except LogError as e:
            yield (part.path, False, records, messages, e.kind, {k: str(v) for k, v in e.details.items()}, "StrictFullScan"), 0


class PushingReader(LogReader):
    """Takes topic and time filters of the plan too; needs spark.sql.python.filterPushdown.enabled."""

    def pushFilters(self, filters):
        w = self.want
        topics, start, end = w.topics, w.start, w.end
        for x in filters:
            name = getattr(x, "attribute", ())
            if name == ("topic",) and isinstance(x, EqualTo) and isinstance(x.value, str):
                topics = frozenset([x.value]) if topics is None else topics & {x.value}
            elif name == ("topic",) and isinstance(x, In):
                topics = frozenset(x.value) if topics is None else topics & frozenset(x.value)
            elif name == ("log_time",) and isinstance(getattr(x, "value", None), int):
                if isinstance(x, (GreaterThanOrEqual, GreaterThan, EqualTo)):
                    start = max(start if start is not None else 0, x.value + isinstance(x, GreaterThan))
                if isinstance(x, (LessThan, LessThanOrEqual, EqualTo)):
                    bound = x.value + (not isinstance(x, LessThan))
                    end = bound if end is None else min(end, bound)
            yield x  # Spark applies every filter again
        from dataclasses import replace

        self.want = replace(w, topics=topics, start=start, end=end)


# -- sink ---------------------------------------------------------------------------------------------------------------
@dataclass
class Written(WriterCommitMessage):
    """A finished recording of a task, its rows, its statistics and where its rejected rows are."""

    temporary: str
    name: str
    rows: int
    statistics: dict
    rejected: int
    rejects: str | None


class RowWriter:
    """Rows of the sink's schema into a recording; declarations come before their first use."""

    def __init__(self, out, options: WriterOptions, policy: str):
        self.writer, self.policy, self.rows = RecordingWriter(out, options), policy.upper(), 0
        if self.policy not in ("FAILFAST", "QUARANTINE"):
            raise ValueError("badRows is FAILFAST or QUARANTINE")
        self.known: dict[tuple, int] = {}
        self.plain: dict[tuple, int] = {}
        self.last: dict[int, int] = {}
        self.rejects: list[tuple[int, str, dict]] = []

    def put_all(self, batch: pa.RecordBatch) -> None:
        """A batch of rows; plain messages go column by column, all else row by row."""
        columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        if not self._plain(columns, batch.num_rows):
            for row in batch.to_pylist():
                self.put(row)
                self.rows += 1
        else:
            self.rows += batch.num_rows

    def _plain(self, columns: dict[str, pa.Array], n: int) -> bool:
        """Writes the batch and tells so if all its rows are messages that can't be rejected."""
        used = {name for name, c in columns.items() if c.null_count < n}
        if not n or self.writer.part is not None or used & {"kind", "channel_metadata"} or not {"topic", "log_time"} <= used or columns["topic"].null_count or columns["log_time"].null_count:
            return False
        none = pa.nulls(n, pa.int64())
        sequence, publish = columns["sequence"] if "sequence" in used else none, columns["publish_time"] if "publish_time" in used else none
        log_time = columns["log_time"].to_numpy(zero_copy_only=False)
        published = pc.coalesce(publish, columns["log_time"]).to_numpy(zero_copy_only=False)
        if sequence.null_count not in (0, n) or log_time.min() < 0 or published.min() < 0:
            return False
        if not sequence.null_count and not 0 <= (values := sequence.to_numpy(zero_copy_only=False)).min() <= values.max() < 1 << 32:
            return False
        # Each combination of a channel's columns is registered once.
        names = [x for x in ABOUT if x in used]
        table = pa.table([columns[x] for x in names], names=names).group_by(names).aggregate([]).to_pylist()
        try:
            ids = {tuple(row.get(x) for x in names): self._channel(row) for row in table}
        except (LogError, ValueError):
            return False  # row by row it is clear which rows came before
        if len(ids) == 1:
            channel = np.full(n, next(iter(ids.values())), np.int64)
        else:
            channel = np.array([ids[k] for k in zip(*(columns[x].to_pylist() for x in names))], np.int64)
        if sequence.null_count:
            values = np.empty(n, np.int64)
            for c in np.unique(channel).tolist():
                mine = np.flatnonzero(channel == c)
                values[mine] = self.last.get(c, -1) + 1 + np.arange(len(mine))
        for c in np.unique(channel).tolist():
            self.last[c] = int(values[np.flatnonzero(channel == c)[-1]])
        data = pc.fill_null(columns["data"], b"") if "data" in used else pa.array([b""] * n, type=pa.binary())
        self.writer.write_encoded(channel, log_time, *columnar.encoded(channel, values, log_time, published, data))
        return True

    def put(self, row: dict) -> None:
        try:
            self._put(row)
        except (LogError, ValueError) as e:
            if self.policy == "FAILFAST" or isinstance(e, LogError) and e.kind not in SAFE and e.kind != "PrivateRecordOpcodeIsReserved":
                raise
            self.rejects.append((self.rows, e.kind if isinstance(e, LogError) else str(e), row))

    def _put(self, row: dict) -> None:
        w, kind, get = self.writer, row.get("kind") or "message", row.get
        if kind == "attachment":
            w.write_attachment(get("name") or "", get("media_type") or "", get("data") or b"", get("log_time") or 0, get("create_time") or 0)
        elif kind == "metadata":
            w.write_metadata(get("name") or "", dict(get("values") or {}))
        elif kind == "private":
            w.write_private(get("opcode"), get("data") or b"", bool(get("in_chunks")))
        elif kind == "attachment_start":
            if get("length") is None:
                raise ValueError("an attachment in parts needs its length")
            w.start_attachment(get("name") or "", get("media_type") or "", get("length"), get("log_time") or 0, get("create_time") or 0)
        elif kind == "attachment_part":
            w.put_attachment(get("data") or b"")
        elif kind == "attachment_finish":
            w.finish_attachment()
        elif kind == "schema":
            w.register_schema(get("schema_name") or "", get("schema_encoding") or "", get("schema_data") or b"", get("schema_id"))
        elif kind in ("channel", "message"):
            channel = self._channel(row)
            if kind == "message":
                if get("log_time") is None:
                    raise ValueError("a message needs a log_time")
                sequence = get("sequence")
                if sequence is None:
                    sequence = self.last.get(channel, -1) + 1
                self.last[channel] = sequence
                log_time = int(get("log_time"))
                w.write(channel, sequence, log_time, int(get("publish_time")) if get("publish_time") is not None else log_time, get("data") or b"")
        else:
            raise ValueError(f"unknown kind of row {kind!r}")

    def _channel(self, row: dict) -> int:
        get = row.get
        if get("topic") is None:
            if get("channel_id") is None:
                raise ValueError("a message needs a topic or a channel_id")
            return get("channel_id")
        metadata = dict(get("channel_metadata") or {})
        key = (get("channel_id"), get("topic"), get("message_encoding"), get("schema_id"), get("schema_name"), get("schema_encoding"), get("schema_data"), tuple(sorted(metadata.items())))
        if key not in self.known:
            schema = get("schema_id") or 0
            if get("schema_name") is not None:
                schema = self.writer.register_schema(get("schema_name"), get("schema_encoding") or "", get("schema_data") or b"", schema or None)
            self.known[key] = self.writer.register_channel(get("topic"), get("message_encoding") or "", schema, metadata, get("channel_id"))
        return self.known[key]


class LogWriter(DataSourceArrowWriter):
    """A recording for each partition, written beside its place and moved there when the job commits."""

    def __init__(self, options: dict[str, str], overwrite: bool):
        path = options.get("path")
        if not path or (here := files.local(path)) is None:
            raise ValueError("recordings are written to local or mounted paths")
        self.path, self.overwrite = here, overwrite
        lower = {k.lower(): v for k, v in options.items()}
        self.options, self.policy, self.sync = WriterOptions.of(options), lower.get("badrows", "FAILFAST"), _flag(lower, "sync", False)
        self.prefix, self.job = lower.get("prefix", "part"), uuid.uuid4().hex
        os.makedirs(self.staging, exist_ok=True)

    @property
    def staging(self) -> str:
        return os.path.join(self.path, "_temporary", self.job)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        context = TaskContext.get()
        part = context.partitionId() if context else 0
        os.makedirs(self.staging, exist_ok=True)
        name = f"{self.prefix}-{part:05d}-{self.job[:8]}{files.SUFFIX}"
        temporary = os.path.join(self.staging, f"{name}.{context.taskAttemptId() if context else 0}")
        with open(temporary, "xb") as out:
            rows = RowWriter(out, self.options, self.policy)
            for batch in iterator:
                rows.put_all(batch)
            summary = rows.writer.complete()
            if self.sync:
                out.flush()
                os.fsync(out.fileno())
        rejects = f"{temporary}.rejects" if rows.rejects else None
        if rejects:
            with open(rejects, "x") as out:
                for number, reason, row in rows.rejects:
                    out.write(json.dumps({"recording": name, "row_number": number, "reason": reason, "row": json.dumps({k: v.hex() if isinstance(v, bytes) else v for k, v in row.items() if v is not None}, default=str)}) + "\n")
        statistics = {k: {str(c): n for c, n in v.items()} if isinstance(v, dict) else v for k, v in summary.statistics._asdict().items()}
        return Written(temporary, name, rows.rows, statistics, len(rows.rejects), rejects)

    def _place(self, temporary: str, name: str) -> None:
        # The link fails if the name exists: a recording is never replaced.
        os.link(temporary, os.path.join(self.path, name))

    def commit(self, messages: list[Written | None]) -> None:
        """Places the recordings of all tasks that got rows, or a single empty one if none did; then their report.

        With overwrite the old files go last: what stops in between leaves both, never neither.
        """
        old = [n for n in os.listdir(self.path) if n.endswith(files.SUFFIX) or n.startswith((REPORT, REJECTS))] if self.overwrite else []
        done = [m for m in messages if m is not None]
        for m in [m for m in done if m.rows] or done[:1]:
            self._place(m.temporary, m.name)
            if m.rejects:
                self._place(m.rejects, f"{REJECTS}{m.name}.jsonl")
        with open(os.path.join(self.staging, "report"), "x") as out:
            for m in done:
                out.write(json.dumps({"job": self.job, "recording": m.name, "rows": m.rows, "rejected": m.rejected, "statistics": m.statistics}) + "\n")
        self._place(os.path.join(self.staging, "report"), f"{REPORT}{self.job}.jsonl")
        for n in old:
            os.unlink(os.path.join(self.path, n))
        self._clean()

    def abort(self, messages: list[Written | None]) -> None:
        self._clean()

    def _clean(self) -> None:
        shutil.rmtree(self.staging, ignore_errors=True)
        try:
            os.rmdir(os.path.join(self.path, "_temporary"))
        except OSError:
            pass


class LogStreamWriter(DataSourceStreamArrowWriter):
    """Every micro-batch is a job of the batch writer; a batch that is repeated finds its files and leaves them."""

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.inner = LogWriter(options, False)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self.inner.write(iterator)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        """Recordings of the tasks that got rows; a batch without rows leaves nothing."""
        for k, m in enumerate(messages):
            if m is None:
                continue
            if m.rows:
                name = f"batch-{batchId:08d}-{k:05d}{files.SUFFIX}"
                for source, target in ((m.temporary, name), *(((m.rejects, f"{REJECTS}{name}.jsonl"),) if m.rejects else ())):
                    if not os.path.exists(os.path.join(self.inner.path, target)):
                        self.inner._place(source, target)
            self._drop(m)

    @staticmethod
    def _drop(m: Written) -> None:
        for path in (m.temporary, m.rejects):
            if path and os.path.exists(path):
                os.unlink(path)

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        for m in messages:
            if m is not None:
                self._drop(m)


# -- stream -------------------------------------------------------------------------------------------------------------
class LogStreamReader(DataSourceStreamReader):
    """Completed recordings of a folder. The offset is the set of those taken (12 characters each), since neither names
    nor times of change tell what is new: a recording may appear with an earlier time than one already read. Files that
    are gone leave the offset too, so a folder that is emptied from time to time keeps it short."""

    def __init__(self, schema, options: dict[str, str]):
        self.reader = LogReader(schema, {**options, "access": "scan"})

    def _files(self) -> dict[str, str]:
        try:
            found = files.expand(self.reader.path)
        except FileNotFoundError:
            return {}
        return {hashlib.sha256(os.path.basename(p).encode()).hexdigest()[:12]: p for p in found if p.endswith(files.SUFFIX)}

    def initialOffset(self) -> dict:
        return {"taken": ""}

    def latestOffset(self) -> dict:
        return {"taken": ",".join(sorted(self._files()))}

    def partitions(self, start: dict, end: dict) -> list[Part]:
        old, new = (set(o["taken"].split(",")) for o in (start, end))
        return [Part(p) for k, p in sorted(self._files().items(), key=lambda x: x[1]) if k in new - old]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        yield from self.reader.read(partition)

    def commit(self, end: dict) -> None:
        """Nothing is kept outside the offsets."""


class FollowingReader(LogStreamReader):
    """Messages of recordings while they grow. The offset is each file's size when it was asked for; a batch has the
    records that end between two sizes, so a record that is half written waits for the rest of it. Damage ends the
    stream; that nothing follows a recording that was never finished is no damage."""

    def __init__(self, schema, options: dict[str, str]):
        super().__init__(schema, options)
        if self.reader.want.table != "messages" or self.reader.want.mode == "recover":
            raise ValueError("only messages are followed, and their prefixes are valid without recovery")

    def initialOffset(self) -> dict:
        return {"sizes": {}}

    def latestOffset(self) -> dict:
        found = self._files()
        sizes = files.sizes(list(found.values()))
        return {"sizes": {k: sizes[p] for k, p in sorted(found.items()) if p in sizes}}

    def partitions(self, start: dict, end: dict) -> list[Part]:
        grown = [(p, start["sizes"].get(k, 0), end["sizes"].get(k, 0)) for k, p in self._files().items()]
        return [Part(p, span=(a, b)) for p, a, b in sorted(grown) if b > a]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        with files.opened(partition.path) as data:
            yield from self.reader._followed(partition, data)


class MessageLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self):
        o = {k.lower(): v for k, v in self.options.items()}
        return model.schema_of(o.get("table", "messages"), o.get("u64", "long"))

    def reader(self, schema):
        push = _flag({k.lower(): v for k, v in self.options.items()}, "pushdown", False)
        return (PushingReader if push else LogReader)(schema, self.options)

    def writer(self, schema, overwrite: bool):
        return LogWriter(self.options, overwrite)

    def streamReader(self, schema):
        follow = _flag({k.lower(): v for k, v in self.options.items()}, "follow", False)
        return (FollowingReader if follow else LogStreamReader)(schema, self.options)

    def streamWriter(self, schema, overwrite: bool):
        return LogStreamWriter(self.options, overwrite)
