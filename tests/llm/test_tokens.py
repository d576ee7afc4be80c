import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from loomlog.llm import packing, token_counts
from loomlog.llm.common import utf8

POOL = ["a", "aaaa", "the ", "ing", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "　", "é", "é", "ß", "漢字", "😀", "123", "4", "'s", "'re", "’", "<|endoftext|>", "<|", "$$", "...", "!!", "\r\n", "​", "हि", "\x00", "Σ", "İ", " ̈", "word. ", "Next one! "]
SCHEMA = "doc_id long, text string, n_tokens int, length string, doc string"


def texts(n, seed=3):
    rnd = random.Random(seed)
    out = ["".join(rnd.choice(POOL) for _ in range(rnd.randint(0, 60))) for _ in range(n)]
    return [*out, None, "", "a" * 3000, "ab " * 20_000, "One two three. " * 3000, " " * 500, "x" * 9_000]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "l", "d") for i, t in rows], SCHEMA)


def test_counts_equal_the_library(spark, monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = [(i if i % 50 else None, t) for i, t in enumerate(texts(800))]
    rows += rows[:3]
    got = token_counts.token_counts(frame(spark, rows).repartition(3), path).collect()
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 512) for i, t in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert token_counts.token_counts(frame(spark, []), path).collect() == []
    # Seams of long texts and a small memory change nothing.
    monkeypatch.setattr(token_counts, "PIECE", 40)
    monkeypatch.setattr(token_counts, "MEMORY", 100)
    plain = [t or "" for _, t in rows]
    assert token_counts.TokenCounter(path).count(plain) == [w[2] for w in want]


def check_pieces(pieces, docs, library, length):
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 2] for i, t in docs}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        own = ids[p["doc"]]
        assert p["doc_tokens"] == len(own) and p["length"] > 0
        assert p["ids_crc32"] == zlib.crc32(np.array(own[p["start"] : p["start"] + p["length"]], "<u4").tobytes())
        by_doc[p["doc"]].append((p["start"], p["length"]))
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    for i, own in ids.items():
        at = 0
        for start, n in sorted(by_doc[i]):
            assert start == at
            at += n
        assert at == len(own)
    used = []
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
        used.append(at)
    return used


@pytest.mark.parametrize("segment", [500, 1 << 20])
def test_every_id_lies_in_one_piece(spark, monkeypatch, segment):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    docs = list(enumerate(texts(500, 9)))
    monkeypatch.setattr(packing, "SEGMENT", segment)
    encoder = packing.WordEncoder(path)
    packer = packing.Packer(128, encoder.stops, 0)
    rows = []
    for i, t in docs:
        rows += packer.add(i, encoder.encode([(t or "").encode()])[0] + b"\2\0\0\0")
    rows += packer.solve(True)
    names = ["doc", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    used = check_pieces([dict(zip(names, r)) for r in rows], docs, library, 128)
    assert sum(128 - n for n in used if n & (n - 1)) < 0.1 * sum(used)


def test_simplified_texts_have_the_same_ids():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, rnd = Tokenizer.from_file(path), random.Random(11)
    pool = ["a", "B.", ".", ",", ", ", ". ", " ", "\n", "é.", "1,", "x..", "'s,", "Word, ", "İ", "..."]
    plain = ["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 12))) for _ in range(5000)]
    raw, at = utf8(pa.array(plain))
    data = packing.simplified(raw).tobytes()
    encoder = packing.WordEncoder(path)
    got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode([data[a:b] for a, b in zip(at.tolist(), at.tolist()[1:])])]
    assert got == [e.ids for e in library.encode_batch(plain, add_special_tokens=False)]


def test_letters_equal_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, rnd = Tokenizer.from_file(path), random.Random(13)
    whole = [t.removesuffix("</w>") for t in library.get_vocab()]
    whole = [t for t in whole if t.isascii() and t.isalpha() and t.islower()]
    words = ["".join(rnd.choice("etaoinshrdlucmfwypvbgkjqxzéèüßñ") for _ in range(rnd.randint(1, 15))) for _ in range(30_000)]
    words += [rnd.choice(whole) + rnd.choice(whole) for _ in range(30_000)] + whole
    encoder = packing.WordEncoder(path)
    got = [np.frombuffer(encoder.letters.encode(w.encode()), "<u4").tolist() for w in words]
    # Words with contractions' letters after an apostrophe don't occur here: a word of letters is one pre-token.
    assert got == [e.ids for e in library.encode_batch_fast(words, add_special_tokens=False)]


def test_pack_query(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    docs = list(enumerate(texts(300, 4)))
    out = packing.pack_sequences(frame(spark, docs).repartition(3), path)
    used = check_pieces([r.asDict() for r in out.collect()], docs, library, 4096)
    assert sum(4096 - n for n in used if n & (n - 1)) < 0.02 * sum(used)
    assert packing.pack_sequences(frame(spark, []), path).collect() == []
    assert packing.pack_sequences(frame(spark, [(None, "a b"), (None, "a b")]), path).count() >= 2


def test_cuts_are_optimal():
    rnd = np.random.default_rng(5)
    for _ in range(30):
        pos = np.unique(np.append(0, rnd.integers(1, 60, 25)))
        pos = np.concatenate([pos[:1], pos[1:][np.diff(pos) <= 20]]) if (np.diff(pos) <= 20).all() else np.arange(0, 60, 7)
        penalty = rnd.integers(0, 9, len(pos)).astype(float)
        cost, _ = packing.cut_windows(pos, penalty, 20)
        want = [0.0]
        for j in range(1, len(pos)):
            want.append(min(want[i] + 20 - (pos[j] - pos[i]) + penalty[j] for i in range(j) if pos[j] - pos[i] <= 20))
        assert np.allclose(cost, want)
