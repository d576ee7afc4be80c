import io
import random

import pytest

from loomlog.sources import format as f
from loomlog.sources import reading as r
from loomlog.sources.errors import LogError
from loomlog.sources.writing import RecordingWriter, WriterOptions

CODECS = ["none", "lz4", "zstd"]


def recording(options=None, build=None):
    out = io.BytesIO()
    w = RecordingWriter(out, options or WriterOptions())
    (build or small)(w)
    return out, w


def small(w):
    s = w.register_schema("value", "jsonschema", b"{}")
    c = w.register_channel("/values", "json", s, {"unit": "é"})
    e = w.register_channel("/events", "text/plain")
    w.write(c, 0, 100, 100, b"1")
    w.write(e, 0, 50, 50, b"x")
    w.write(c, 1, 110, 110, b"")
    w.write_metadata("recording", {"a": "b"})
    w.write_attachment("notes.txt", "text/plain", b"hello", 1, 2)
    w.start_attachment("parts.txt", "text/plain", 4)
    w.put_attachment(b"ab")
    w.put_attachment(b"cd")
    w.finish_attachment()
    w.complete()


def messages(data, options=r.ReaderOptions()):
    return [r.message_of(x.body) for x, _, _ in r.checked_scan(data, options) if x.opcode == f.MESSAGE]


@pytest.mark.parametrize("codec", CODECS)
@pytest.mark.parametrize("chunks", [True, False])
def test_round_trip(codec, chunks):
    out, w = recording(WriterOptions(compression=codec, use_chunks=chunks, chunk_size=16))
    assert [m.log_time for m in messages(out, r.ReaderOptions.strict())] == [100, 50, 110]
    assert r.validate(out) > 0
    s = r.read_summary(out)
    assert s.statistics == w.complete().statistics and (s.statistics.message_count, s.statistics.attachment_count) == (3, 2)
    assert s.channels[0].metadata == {"unit": "é"} and s.schemas[1].name == "value"
    assert r.index_usable(out, s) == chunks
    opcode, body = r.record_at(out, s.attachment_indexes[1].offset)
    assert f.parse(opcode, body).data == b"abcd" and len(body) + 9 == s.attachment_indexes[1].length
    if chunks:
        assert s.statistics.chunk_count == len(s.chunk_indexes) > 1
        index = s.chunk_indexes[0]
        raw = out.getvalue()
        assert raw[f.data_offset(index) :][: index.compressed_size] == r.chunk_at(out, index).data
        for channel, at in index.message_index_offsets.items():
            got = f.parse(*r.record_at(out, at))
            expanded = f.expand(r.chunk_at(out, index))
            assert got.entries == [(t, o) for c, t, o in f.indexed_records(expanded) if c == channel]


def test_every_truncation_fails_and_recovers_a_prefix():
    def build(w):
        w.register_channel("/ü", "b", id=7)
        w.write(7, 2**32 - 1, 2**64 - 1, 0, bytes([42]))
        w.write(7, 1, 5, 6, bytes([43]))
        w.complete()

    out, _ = recording(WriterOptions(use_chunks=False), build)
    whole = out.getvalue()
    assert [m.log_time for m in messages(out)] == [2**64 - 1, 5]
    for n in range(len(whole)):
        cut = io.BytesIO(whole[:n])
        with pytest.raises(LogError):
            r.validate(cut)
        got = list(r.recover(cut))
        assert isinstance(got[-1], LogError) and [x[1].sequence for x in got[:-1]] == [2**32 - 1, 1][: len(got) - 1]


@pytest.mark.parametrize("marker", [b"hello", b"{}", b"/values"])
def test_bit_flips_are_found(marker):
    out, _ = recording(WriterOptions(compression="none"))
    raw = bytearray(out.getvalue())
    for at in (raw.find(marker), raw.rfind(marker)):
        bad = raw.copy()
        bad[at] ^= 1
        with pytest.raises(LogError) as e:
            r.validate(io.BytesIO(bytes(bad)))
        assert e.value.kind in ("BadAttachmentCrc", "BadChunkCrc", "BadDataCrc", "BadSummaryCrc", "Parse", "ConflictingSchemas")


def test_safe_rejections_leave_the_writer_usable():
    out = io.BytesIO()
    w = RecordingWriter(out)
    w.register_schema("a", "e", b"", 3)
    w.register_channel("/t", "e", 3, id=1)
    for kind, call in (
        ("InvalidSchemaId", lambda: w.register_schema("x", "e", b"", 0)),
        ("ConflictingSchemas", lambda: w.register_schema("b", "e", b"", 3)),
        ("UnknownSchema", lambda: w.register_channel("/u", "e", 9)),
        ("ConflictingChannels", lambda: w.register_channel("/v", "e", 3, id=1)),
        ("UnknownChannel", lambda: w.write(5, 0, 0, 0, b"")),
        ("PrivateRecordOpcodeIsReserved", lambda: w.write_private(5, b"")),
    ):
        with pytest.raises(LogError) as e:
            call()
        assert e.value.kind == kind
    w.start_attachment("a", "t", 2)
    with pytest.raises(ValueError):
        w.write(1, 0, 0, 0, b"")
    with pytest.raises(LogError):
        w.put_attachment(b"abc")
    with pytest.raises(LogError):
        w.finish_attachment()
    w.put_attachment(b"ab")
    w.finish_attachment()
    w.write(1, 0, 0, 0, b"")
    assert w.complete() is w.complete() and r.validate(out)


def test_switches():
    out, w = recording(WriterOptions(emit_summary=False, emit_summary_offsets=False))
    assert r.read_summary(out) is None and w.complete().statistics.message_count == 3
    out, _ = recording(WriterOptions(emit_summary=False, repeat_channels=True))
    s = r.read_summary(out)
    assert s.statistics is None and len(s.channels) == 2 and not s.schemas and not r.index_usable(out, s)
    out, _ = recording(WriterOptions(emit_message_indexes=False, chunk_crcs=False, data_crc=False, summary_crc=False))
    s = r.read_summary(out)
    assert r.index_usable(out, s) and s.chunk_indexes[0].message_index_length == 0 and r.validate(out)
    assert WriterOptions.of({"Compression": "LZ4", "chunkSize": "7", "emitStatistics": "false"}) == WriterOptions(compression="lz4", chunk_size=7, emit_statistics=False)


def test_chunk_boundaries():
    def build(w):
        w.register_channel("/a", "b", id=0)
        for i in range(2):
            w.write(0, i, i, i, b"z" * 70_000)
        w.complete()

    _, w = recording(WriterOptions(chunk_size=1024), build)
    assert w.complete().statistics.chunk_count == 2


def test_private_records_and_origin():
    def build(w):
        w.register_channel("/a", "b", id=9)
        w.write_private(0x80, b"in", True)
        w.write_private(0x81, b"out")
        w.write(9, 0, 0, 0, b"abc")
        w.complete()

    out, _ = recording(WriterOptions(), build)
    shifted = io.BytesIO(b"j" * 17 + out.getvalue())
    got = [(x.opcode, bytes(x.body)) for x in r.scan(shifted, r.ReaderOptions(start_offset=17)) if x.opcode >= 0x80]
    assert got == [(0x80, b"in"), (0x81, b"out")]
    s = r.read_summary(shifted, 17)
    assert r.index_usable(shifted, s, 17) and f.expand(r.chunk_at(shifted, s.chunk_indexes[0], 17))


def test_bad_references_and_limits():
    out, _ = recording(WriterOptions(use_chunks=False, emit_summary=False, data_crc=False))
    raw = out.getvalue()
    at = raw.find(f.encode(f.Channel(1, 0, "/events", "text/plain", {})))
    bad = bytearray(raw)
    bad[at + 11 : at + 13] = (123).to_bytes(2, "little")
    with pytest.raises(LogError) as e:
        r.validate(io.BytesIO(bytes(bad)))
    assert e.value.kind == "UnknownSchema" and e.value.details["schema_id"] == 123
    bad = bytearray(raw)
    bad[at] = 0x80
    with pytest.raises(LogError) as e:
        messages(io.BytesIO(bytes(bad)))
    assert e.value.kind == "UnknownChannel"
    with pytest.raises(LogError) as e:
        messages(out, r.ReaderOptions(record_limit=10))
    assert e.value.kind == "RecordTooLarge"
    long = LogError("UnsupportedCompression", "m" * 999, compression="c" * 999)
    assert len(long.details["compression"].encode()) <= 128 and long.details["truncated"]


def test_generated_recordings_agree_on_all_paths():
    for seed in range(12):
        rnd = random.Random(seed)
        rows = [(rnd.choice([1, 2]), i, rnd.randint(0, 63), rnd.randint(0, 9), bytes(rnd.randint(0, 255) for _ in range(rnd.randint(0, 511)))) for i in range(rnd.randint(1, 256))]

        def build(w, rows=rows):
            w.register_schema("s", "e", b"d", 1)
            w.register_channel("/1", "e", 1, id=1)
            w.register_channel("/2", "e", id=2)
            for row in rows:
                w.write(*row)
            w.complete()

        out, _ = recording(WriterOptions(compression=CODECS[seed % 3], use_chunks=seed % 2 == 0, chunk_size=rnd.choice([1, 4096, 1 << 20])), build)
        assert [tuple(m) for m in messages(out)] == rows
        s = r.read_summary(out)
        if seed % 2 == 0:
            got = [tuple(r.message_of(b)) for i in s.chunk_indexes for _, op, b in f.walk(f.expand(r.chunk_at(out, i))) if op == f.MESSAGE]
            assert got == rows
