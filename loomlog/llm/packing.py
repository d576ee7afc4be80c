"""Order-preserving packing of token streams by dynamic programming with a monotone queue.

The documents of a scan task form one stream of tokens in stored order. Windows of at most ``length`` tokens are cut
at document ends, at sentence ends, or (only where a sentence is too long) anywhere. With positions p and penalties q:

    cost(j) = q(j) + (length - p(j)) + min over i, p(j) - p(i) <= length, of (cost(i) + p(i))

The minimum over a sliding range is kept in a monotone queue, so the cuts of a segment take linear time. A segment is
solved whenever enough tokens are buffered; its unfinished last window opens the next segment. The tail of a task
fills windows whose sizes are powers of two, which need no padding. Map-only: nothing is shuffled, and memory is
bounded by the segment, one document and an Arrow batch.

Null text is empty and still has its end token; a null identifier is carried through; an empty table gives no rows.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from loomlog.llm.common import kept, lowered, pick, prepare, tidy, utf8
from loomlog.llm.token_counts import byte_alphabet

#: Penalties, in tokens of padding, of cutting a document at a sentence end or inside a sentence.
SENTENCE_CUT, HARD_CUT = 8, 128
#: Inside sentences longer than a quarter window cuts are allowed every so many tokens.
HARD_STEP = 256
#: Texts encoded at a time.
GROUP = 512
#: Tokens of a segment, words whose ids a worker remembers (twice that many, some 150 bytes each), bytes of a text cut
#: into words at a time.
SEGMENT, MEMORY, PIECE = 1 << 20, 1_000_000, 1 << 20

_PLAIN = re.compile("([a-zß-öø-ÿ]+)([.,]?)")

SCHEMA = "doc long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class LetterEncoder:
    """Byte-pair merging of words of lower-case Latin-1 letters by the ranks of the vocabulary.

    The last byte of a word is a symbol of its own there, so it gets a code of its own: 91 bytes occur in such words,
    182 codes fit a byte. Merging the adjacent symbols whose join has the lowest id gives the merges' result.
    """

    _BYTES = (*range(0x61, 0x7B), 0xC3, *range(0x80, 0xC0))

    def __init__(self, vocab: dict[str, int]):
        import tiktoken

        names = {c: i for i, c in enumerate(byte_alphabet())}
        inner = {b: i for i, b in enumerate(self._BYTES)}
        last = {b: i + len(self._BYTES) for i, b in enumerate(self._BYTES)}
        ranks: dict[bytes, int] = {}
        for token, i in vocab.items():
            core = token.removesuffix("</w>")
            raw = [names.get(c, -1) for c in core]
            if raw and all(b in inner for b in raw):
                ranks[bytes([*(inner[b] for b in raw[:-1]), (inner if core == token else last)[raw[-1]]])] = i
        for code in range(256):  # the library wants all single bytes
            ranks.setdefault(bytes([code]), max(vocab.values()) + 1 + code)
        self.piece = tiktoken.Encoding("letters", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.inner = bytes(inner.get(b, 0) for b in range(256))
        self.last = {b: bytes([c]) for b, c in last.items()}

    def encode(self, word: bytes) -> bytes:
        return array("I", self.piece(word[:-1].translate(self.inner) + self.last[word[-1]])).tobytes()


class WordEncoder:
    """Ids of texts for a tokenizer that drops white space: words are encoded once and remembered as bytes."""

    def __init__(self, path: str, memory: int = MEMORY):
        self.memory = memory
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.letters = LetterEncoder(vocab)
        self.marks = {t: array("I", self.tokenizer.encode(t, add_special_tokens=False).ids).tobytes() for t in ".,"}
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.stops = np.zeros(max(vocab.values()) + 3, dtype=bool)
        for token, i in vocab.items():
            # A word that ends in . ! or ? (perhaps quoted) ends a sentence.
            if token.endswith("</w>") and token[:-4].rstrip("\"')").endswith((".", "!", "?")):
                self.stops[i] = True

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; new words are encoded a few MB of text at a time."""
        out, group, size = [], [], 0
        for text in texts:
            if len(text) > PIECE:
                out += self._group(group) + [b"".join(self._group([piece])[0] for piece in pieces(text))]
                group, size = [], 0
                continue
            group.append(text)
            size += len(text)
            if size > PIECE:
                out += self._group(group)
                group, size = [], 0
        return out + self._group(group)

    def _group(self, texts: list[bytes]) -> list[bytes]:
        split = [t.split() for t in texts]
        if len(self.known) > self.memory:  # the older half is kept aside; what is met again comes back
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        out, late, new = [], [], set()
        for k, words in enumerate(split):
            found = list(map(known.get, words))
            if None in found:
                missing = [i for i, ids in enumerate(found) if ids is None]
                new.update([words[i] for i in missing])
                late.append((k, found, missing))
                out.append(b"")
            else:
                out.append(b"".join(found))
        again = new.intersection(older) if older else ()
        known.update((w, older[w]) for w in again)
        new = list(new.difference(again))
        for a in range(0, len(new), 10_000):
            self._learn([w.decode("utf-8") for w in new[a : a + 10_000]])
        for k, found, missing in late:
            words = split[k]
            for i in missing:
                found[i] = known[words[i]]
            out[k] = b"".join(found)
        return out

    def _learn(self, words: list[str]) -> None:
        """Ids of new words. Lower-case Latin-1 letters, and a full stop or comma after them, are pre-tokens of their
        own that no normaliser changes."""
        known = self.known
        plain, other, stopped = set(), [], []
        for t in words:
            if m := _PLAIN.fullmatch(t):
                core, stop = m.groups()
                if stop:
                    stopped.append((t, core, stop))
                if (raw := core.encode()) not in known:
                    plain.add(raw)
            else:
                other.append(t)
        for t in plain:
            known[t] = self.letters.encode(t)
        for t, e in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False)):
            known[t.encode()] = array("I", e.ids).tobytes()
        for t, core, stop in stopped:
            known[t.encode()] = known[core.encode()] + self.marks[stop]


def pieces(text: bytes) -> Iterator[bytes]:
    """Parts of a long text, cut at spaces."""
    at = 0
    while len(text) - at > PIECE:
        seam = text.rfind(b" ", at + 1, at + PIECE)
        seam = seam if seam > 0 else text.find(b" ", at + PIECE)
        if seam < 0:
            break
        yield text[at:seam]
        at = seam
    yield text[at:]


def simplified(raw: np.ndarray) -> np.ndarray:
    """Texts with fewer different words and the same ids: lower case, as the tokenizer lowers anyway.

    Texts with the beginning of a special string are left alone, as those are matched before lower-casing.
    """
    return raw if raw.tobytes().find(b"<|") >= 0 else lowered(raw)


def cut_windows(pos: np.ndarray, penalty: np.ndarray, length: int) -> tuple[list[float], list[int]]:
    """cost and best predecessor of every boundary; pos[0] is the start, gaps are at most ``length``."""
    p, q = pos.tolist(), penalty.tolist()
    n = len(p)
    cost, back = [0.0] * n, [0] * n
    queue, value, head = [0] * n, [0.0] * n, 0
    queue[0], value[0], tail = 0, float(p[0]), 1
    for j in range(1, n):
        least = p[j] - length
        while p[queue[head]] < least:
            head += 1
        i = queue[head]
        c = q[j] - p[j] + length + value[head]
        cost[j], back[j] = c, i
        c += p[j]
        while tail > head and value[tail - 1] > c:
            tail -= 1
        queue[tail], value[tail] = j, c
        tail += 1
    return cost, back


class Packer:
    """Buffers documents of one task and yields pieces: (doc, start, length, crc, doc_tokens, sequence, offset)."""

    def __init__(self, length: int, stops: np.ndarray, first_sequence: int):
        self.length, self.stops, self.sequence = length, stops, first_sequence
        self.docs: list[tuple] = []  # identifier, ids as bytes, tokens already packed
        self.tokens = 0

    def add(self, identifier, ids: bytes) -> list[tuple]:
        self.docs.append((identifier, ids, 0))
        self.tokens += len(ids) // 4
        return self.solve(False) if self.tokens >= SEGMENT else []

    def solve(self, final: bool) -> list[tuple]:
        if not self.docs:
            return []
        flat = np.frombuffer(b"".join([ids[4 * a :] for _, ids, a in self.docs]), dtype="<u4")
        ends = np.cumsum([len(ids) // 4 - a for _, ids, a in self.docs])
        pos, penalty = self._boundaries(flat, ends)
        cost, back = cut_windows(pos, penalty, self.length)
        # The last window stays open: of the boundaries within one window of the end the cheapest closes the others.
        open_from = int(np.searchsorted(pos, max(0, int(ends[-1]) - self.length + (0 if final else 1))))
        j = min(range(open_from, len(cost)), key=lambda k: (cost[k] + (int(ends[-1]) - pos[k]) * 1e-6))
        rest, cuts = int(pos[j]), []
        while j:
            cuts.append(int(pos[j]))
            j = back[j]
        cuts.reverse()
        if final:
            left, at = int(ends[-1]) - rest, rest
            for bit in range(left.bit_length() - 1, -1, -1):
                if left >> bit & 1:
                    at += 1 << bit
                    cuts.append(at)
            rest = at
        out = self._pieces(np.array([0, *cuts]), ends)
        keep = int(np.searchsorted(ends, rest, "right"))
        kept = self.docs[keep:]
        if kept:
            before = int(ends[keep - 1]) if keep else 0
            identifier, ids, a = kept[0]
            kept[0] = (identifier, ids, a + rest - before)
        self.docs, self.tokens = kept, int(ends[-1]) - rest
        return out

    def _boundaries(self, flat: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        stops = np.flatnonzero(self.stops[flat]) + 1
        pos = np.unique(np.concatenate([[0], stops, ends]))
        wide = np.flatnonzero(np.diff(pos) > self.length // 4)
        if len(wide):
            step = min(HARD_STEP, max(1, self.length // 8))
            pos = np.unique(np.concatenate([pos, *(np.arange(pos[i] + step, pos[i + 1], step) for i in wide)]))
        penalty = np.full(len(pos), float(HARD_CUT))
        penalty[np.searchsorted(pos, stops)] = SENTENCE_CUT
        penalty[np.searchsorted(pos, ends)] = 0
        return pos, penalty

    def _pieces(self, cuts: np.ndarray, ends: np.ndarray) -> list[tuple]:
        if len(cuts) < 2:
            return []
        starts = np.append(0, ends[:-1])
        marks = np.unique(np.concatenate([cuts, ends[ends < cuts[-1]]]))
        a, b = marks[:-1], marks[1:]
        doc = np.searchsorted(ends, a, "right")
        window = np.searchsorted(cuts, a, "right") - 1
        out = []
        for lo, hi, d, w, s in zip(a.tolist(), b.tolist(), doc.tolist(), window.tolist(), (a - cuts[window]).tolist()):
            identifier, ids, done = self.docs[d]
            start = lo - int(starts[d]) + done
            out.append((identifier, start, hi - lo, zlib.crc32(ids[4 * start : 4 * (start + hi - lo)]), len(ids) // 4, self.sequence + w, s))
        self.sequence += len(cuts) - 1
        return out


def _pack(path: str, length: int, end_id: int, memory: int):
    end = np.array([end_id], dtype="<u4").tobytes()

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        names = [c.split(" ")[0] for c in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], type=pa.int64()) for i in range(7)], names=names)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept((path, memory), lambda: WordEncoder(path, memory))
        packer = Packer(length, encoder.stops, TaskContext.get().partitionId() << 40)
        for batch in batches:
            raw, at = utf8(batch.column(1))
            data, at = simplified(raw).tobytes(), at.tolist()
            for lo in range(0, batch.num_rows, GROUP):
                texts = [data[a:b] for a, b in zip(at[lo : lo + GROUP], at[lo + 1 : lo + GROUP + 1])]
                for identifier, ids in zip(batch.column(0)[lo : lo + GROUP].to_pylist(), encoder.encode(texts)):
                    if rows := packer.add(identifier, ids + end):
                        yield batch_of(rows)
        if rows := packer.solve(True):
            yield batch_of(rows)

    return pack


def pack_sequences(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", length: int = 4096, end_id: int = 2, memory: int = MEMORY) -> DataFrame:
    """One row per piece: doc, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    prepare(docs.sparkSession)
    rows = pick(docs, doc=f"{id_col} long", text=f"{text_col} string")
    return rows.mapInArrow(tidy(_pack(tokenizer_path, length, end_id, memory), keeps=True), SCHEMA)
