"""Token counts by rank-synchronous array merging (byte-level BPE).

Texts are cut into pre-tokens. The distinct new pre-tokens of a batch are held as one ragged numpy array of symbols;
in every step each sequence merges all occurrences of its own lowest-ranked pair, whatever that rank is, until no
sequence has a pair left. The surviving symbols are counted and remembered per pre-token (a bounded memory).

Merging all occurrences at once equals merging them from left to right: a pair made with a new symbol always ranks
after the merge that made the symbol, and in a run of equal symbols every second pair is taken from the left.

Map-only: no shuffle, memory bounded by an Arrow batch, the memory of counts and one text. Null text is empty and has
no tokens; special strings inside texts count as one token, the tokenizer file's default.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame

from loomlog.llm.common import pick, prepare, tidy

#: Pre-tokens whose counts are remembered by a worker, symbols merged at a time, and characters cut at a time.
MEMORY, SYMBOLS, PIECE = 400_000, 400_000, 1 << 20

#: Fixed value: the pre-token pattern of byte-level BPE, with white space as Unicode defines it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"

_NONE = np.int32(2**31 - 1)


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: printable ones stand for themselves, the others follow U+0100."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = (b for b in range(256) if b not in set(shown))
    names = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [names[b] for b in range(256)]


class RankSynchronous:
    """Merges many sequences at a time with the merges of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.first = np.array([vocab[c] for c in byte_alphabet()], dtype=np.int64)
        self.width = np.int64(max(vocab.values()) + 1)
        keys = np.array([vocab[a] * int(self.width) + vocab[b] for a, b in merges], dtype=np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = np.append(keys[order], np.int64(2**62)), np.append(order, _NONE).astype(np.int32)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.split = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.width + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)

    def count(self, tokens: list[bytes]) -> np.ndarray:
        """Symbols that survive in each pre-token."""
        out = np.array([len(t) for t in tokens], dtype=np.int64)
        if not len(out):
            return out
        # Sequences of similar length go together, so that short ones don't wait for long ones.
        order = np.argsort(out, kind="stable")
        ends = np.cumsum(out[order])
        cut = 0
        while cut < len(order):
            to = max(cut + 1, int(np.searchsorted(ends, (ends[cut - 1] if cut else 0) + SYMBOLS, "right")))
            own = order[cut:to]
            out[own] = self._merge(b"".join([tokens[i] for i in own]), out[own])
            cut = to
        return out

    def _merge(self, data: bytes, lengths: np.ndarray) -> np.ndarray:
        done = lengths.copy()
        sym = self.first[np.frombuffer(data, np.uint8)]
        seq = np.repeat(np.arange(len(lengths)), lengths)
        last = np.append(seq[1:] != seq[:-1], True)
        rank = np.full(len(sym), _NONE, dtype=np.int32)
        inner = np.flatnonzero(~last)
        rank[inner] = self.rank(sym[inner], sym[inner + 1])
        while len(sym):
            starts = np.flatnonzero(np.append(True, seq[1:] != seq[:-1]))
            sizes = np.diff(np.append(starts, len(seq)))
            lowest = np.minimum.reduceat(rank, starts)
            ended = lowest == _NONE
            done[seq[starts[ended]]] = sizes[ended]
            each = np.repeat(lowest, sizes)
            hit = (rank == each) & (each != _NONE)
            at = np.flatnonzero(hit)
            if not len(at):
                break
            # In a run of overlapping hits (a a a) every second one is taken, from the left.
            run = np.append(True, (at[1:] != at[:-1] + 1) | (seq[at[1:]] != seq[at[:-1]]))
            head = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - head) % 2 == 0]
            sym[at] = self.made[rank[at]]
            stale = np.zeros(len(sym), dtype=bool)
            stale[at] = True
            keep = ~np.repeat(ended, sizes)
            keep[at + 1] = False
            sym, seq, rank, stale = sym[keep], seq[keep], rank[keep], stale[keep]
            stale[:-1] |= stale[1:].copy()
            last = np.append(seq[1:] != seq[:-1], True) if len(seq) else stale
            rank[last] = _NONE
            fresh = np.flatnonzero(stale & ~last)
            rank[fresh] = self.rank(sym[fresh], sym[fresh + 1])
        return done


class TokenCounter:
    """Counts tokens of texts; remembers at most MEMORY pre-tokens."""

    _pattern = regex.compile(PATTERN)
    _seam = regex.compile(r"(?<=[\p{L}\p{N}])(?= \p{L})")

    def __init__(self, path: str):
        self.engine = RankSynchronous(path)
        self.known: dict[str, int] = {}

    def _plain(self, text: str) -> Iterator[str]:
        """Parts of a long text; a seam between a letter and a space before a letter always parts pre-tokens."""
        at = 0
        while len(text) - at > PIECE:
            m = self._seam.search(text, at + PIECE)
            if not m:
                break
            yield text[at : m.start()]
            at = m.start()
        yield text[at:] if at else text

    def count(self, texts: list[str]) -> list[int]:
        """Texts are taken a few MB at a time."""
        out, group, size = [], [], 0
        for t in texts:
            group.append(t)
            size += len(t)
            if size > 4 * PIECE:
                out += self._group(group)
                group, size = [], 0
        return out + self._group(group)

    def _group(self, texts: list[str]) -> list[int]:
        totals = [0] * len(texts)
        pending: list[tuple[int, list[str]]] = []
        new: set[str] = set()
        held = 0

        def settle() -> None:
            nonlocal held
            fresh = list(new)
            fresh_counts = dict(zip(fresh, self.engine.count([x.encode("utf-8") for x in fresh]).tolist()))
            self.known.update(fresh_counts)
            look = self.known.__getitem__
            for i, tokens in pending:
                totals[i] += sum(map(look, tokens))
            pending.clear()
            new.clear()
            held = 0
            if len(self.known) > MEMORY:
                self.known.clear()

        for i, text in enumerate(texts):
            if not text:
                continue
            parts = self.engine.split.split(text) if self.engine.split else [text]
            totals[i] += len(parts) - 1
            for part in parts:
                for piece in self._plain(part):
                    tokens = self._pattern.findall(piece)
                    pending.append((i, tokens))
                    new.update(t for t in set(tokens) if t not in self.known)
                    held += len(tokens)
                    if held > 2_000_000:
                        settle()
        settle()
        return totals


_counters: dict[str, TokenCounter] = {}


def counter_of(path: str) -> TokenCounter:
    """The worker's own counter. A function of the module, as a task's closure would bring a new, empty dictionary."""
    if path not in _counters:
        _counters[path] = TokenCounter(path)
    return _counters[path]


def _count(path: str, limit: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(path)
        for batch in batches:
            texts = batch.column(1).fill_null("")
            n = counter.count(texts.to_pylist())
            size = pa.compute.binary_length(texts).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), size, pa.array(n, type=pa.int64()), pa.array([x > limit for x in n], type=pa.bool_())], names=["doc", "n_bytes", "n_tokens", "over_limit"])

    return count


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """One row per input row: doc, n_bytes, n_tokens, over_limit. An empty table gives no rows."""
    prepare(docs.sparkSession)
    rows = pick(docs, doc=f"{id_col} long", text=f"{text_col} string")
    return rows.mapInArrow(tidy(_count(tokenizer_path, limit)), "doc long, n_bytes long, n_tokens long, over_limit boolean")
