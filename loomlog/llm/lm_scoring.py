"""Language-model scoring with Brown class-based n-grams over the whole vocabulary.

    P(word | previous word) = P(h(word) | g(previous word)) * P(word | h(word))

Two maps assign words to classes, both by exchange: a word moves to the class where the likelihood of the class bigrams
is highest. Scans over whole texts (words lower-cased in A-Z, and one end per text):

1. word counts of the training texts, pre-aggregated in each task, then summed by word hash;
2. bigrams of *symbols*: the HEAD most frequent words, the end, and one symbol for each of GROUPS endings of all other
   words. Exchange on the driver assigns these symbols to classes: the map g, by which a word serves as context. It is
   small enough for each task to know, so the context of a token never needs a join;
3. how often each word follows each class of g. From these vectors, one for every word of the vocabulary, the executors
   exchange words between the classes of h: all words at once against the class bigrams of the round before, half of the
   words in each round. A round is a pass over the vectors and one matrix of classes x classes; texts aren't read again,
   and as a word's moves follow from its vector and the matrices, nothing but the vectors is stored;
4. scores: log10 of the product above. Counts and classes of the LOOKUP most frequent words are broadcast (a fixed
   size); rarer words are joined with the vocabulary by a shuffle, where no key is frequent any more. A word that the
   training texts lack has the class of its ending and the share of one more word of that class.

The base score is the add-one unigram score over the same counts. Word identity is a 64-bit hash.

Rows carry their own number from the checkpointed scan, so repeated or null identifiers are scored one by one. Null
text is empty: its only token is the end. A very long text is read in pieces of whole rows and scored whole. Without
training texts all probabilities are uniform. Further columns are ignored, whatever their names. An empty table gives
no rows. Ties in frequency go to the smaller hash, ties between classes to the first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomlog.llm.common import durable, lowered, pick, prepare, tidy, utf8, words_of
from loomlog.llm.hashing import mix, range_hashes

#: Symbols of the context map (words, endings), classes of each map, counts that are broadcast.
HEAD, GROUPS, CLASSES, LOOKUP = 768, 128, 48, 1 << 18
#: Rounds of the exchange on the driver and of the one over the vocabulary, and the weight of the class unigram.
ROUNDS, WORD_ROUNDS, BACKOFF = 8, 2, 20.0
#: Words whose counts a task holds before it folds them, bytes of text taken at a time.
FOLD, PIECE = 2_000_000, 2 << 20

_END = HEAD + GROUPS
SYMBOLS = _END + 1


def held_out(identifier: int | None, parts: int = 7, part: int = 2) -> bool:
    return zlib.crc32(b"" if identifier is None else str(identifier).encode()) % parts == part


def tokens(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Parts of a batch: first and last row, word hashes, endings, and the n+1 positions of the rows among them."""
    raw, at = utf8(batch.column(1))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + PIECE, "right")) - 1)
        part = lowered(raw[at[lo] : at[hi]])
        starts, ends, rows = words_of(part, at[lo : hi + 1] - at[lo])
        back = lambda k: np.where(ends - starts >= k, part[np.maximum(ends - k, 0)], 0).astype(np.uint32)
        ending = ((back(1) * np.uint32(65599) + back(2)) * np.uint32(65599) + back(3)) * np.uint32(2654435761)
        yield lo, hi, range_hashes(part, starts, ends).view(np.int64), (ending >> np.uint32(16)) % np.uint32(GROUPS), rows
        lo = hi


def _of_training(batch: pa.RecordBatch, lo: int, hi: int, rows: np.ndarray) -> np.ndarray:
    train = np.array([not held_out(i) for i in batch.column(0)[lo:hi].to_pylist()], dtype=bool)
    return np.repeat(train, np.diff(rows))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def fold() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        word, group, n = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(word, kind="stable")
        word, group, n = word[order], group[order], n[order]
        at = np.flatnonzero(np.append(True, word[1:] != word[:-1])[: len(word)])
        return word[at], group[at], np.add.reduceat(n, at) if len(at) else n

    def out(word: np.ndarray, group: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(word), 1 << 18):
            yield pa.RecordBatch.from_arrays([pa.array(x[a : a + (1 << 18)], type=t) for x, t in ((word, pa.int64()), (group.astype(np.int32), pa.int32()), (n, pa.int64()))], names=["word", "ending", "c"])

    for batch in batches:
        for lo, hi, word, group, rows in tokens(batch):
            mine = _of_training(batch, lo, hi, rows)
            held.append((word[mine], group[mine], np.ones(int(mine.sum()), np.int64)))
            size += len(held[-1][0])
            if size > FOLD:
                held = [fold()]
                size = len(held[0][0])
                if size > FOLD // 2:  # hardly any word came twice: hand it on
                    yield from out(*held[0])
                    held, size = [], 0
    if held:
        yield from out(*fold())


def symbols_of(word: np.ndarray, group: np.ndarray, head: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Symbols of words; head is sorted, ids are the symbols of its words."""
    if not len(head):
        return HEAD + group.astype(np.int64)
    at = np.minimum(np.searchsorted(head, word), len(head) - 1)
    return np.where(head[at] == word, ids[at], HEAD + group.astype(np.int64))


def with_ends(symbols: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's symbols and its end, and the symbols before them (an end before the first)."""
    n = np.diff(rows)
    at = rows[1:] + np.arange(len(n))
    out = np.full(len(symbols) + len(n), _END, dtype=np.int64)
    inner = np.ones(len(out), dtype=bool)
    inner[at] = False
    out[inner] = symbols
    return out, np.append(_END, out[:-1]) if len(out) else out


def _bigrams(head: np.ndarray, ids: np.ndarray):
    def bigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS * SYMBOLS, dtype=np.int64)
        for batch in batches:
            for lo, hi, word, group, rows in tokens(batch):
                train = np.array([not held_out(i) for i in batch.column(0)[lo:hi].to_pylist()], dtype=bool)
                now, before = with_ends(symbols_of(word, group, head, ids), rows)
                mine = np.repeat(train, np.diff(rows) + 1)
                total += np.bincount((before * SYMBOLS + now)[mine], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["pair", "c"])

    return bigrams


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def exchange(counts: np.ndarray, classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """Class of each symbol, by moving one symbol at a time to the class where the bigram likelihood is highest.

    The last symbol (the end) keeps class 0 to itself; symbols that never occur keep their first class.
    """
    n = len(counts)
    counts = counts.astype(np.float64)
    out, into = counts.sum(axis=1), counts.sum(axis=0)
    order = np.argsort(-(out + into)[: n - 1], kind="stable")
    label = np.zeros(n, dtype=np.int64)
    label[order] = 1 + np.arange(n - 1) % max(1, classes - 1)
    member = np.eye(classes)[label]
    after, before = counts @ member, counts.T @ member  # of each symbol: what follows and precedes it, by class
    pairs, left, right = member.T @ after, member.T @ out, member.T @ into
    for _ in range(rounds):
        moved = 0
        for w in order[(out + into)[order] > 0]:
            old, own = int(label[w]), counts[w, w]
            r, l = after[w].copy(), before[w].copy()
            r[old] -= own
            l[old] -= own
            pairs[old] -= r
            pairs[:, old] -= l
            pairs[old, old] -= own
            left[old] -= out[w]
            right[old] -= into[w]
            # The change of the likelihood if class c takes w: its row, its column, its diagonal, its totals.
            was, d = _xlogx(pairs), pairs.diagonal()
            gain = (_xlogx(pairs + r) - was).sum(axis=1) + (_xlogx(pairs.T + l) - was.T).sum(axis=1)
            gain += _xlogx(d + r + l + own) - _xlogx(d + r) - _xlogx(d + l) + _xlogx(d)
            gain -= _xlogx(left + out[w]) - _xlogx(left) + _xlogx(right + into[w]) - _xlogx(right)
            gain[0] = -np.inf
            best = int(gain.argmax())
            new = best if gain[best] > gain[old] + 1e-9 else old
            pairs[new] += r
            pairs[:, new] += l
            pairs[new, new] += own
            left[new] += out[w]
            right[new] += into[w]
            if new != old:
                label[w] = new
                after[:, old] -= counts[:, w]
                after[:, new] += counts[:, w]
                before[:, old] -= counts[w]
                before[:, new] += counts[w]
                moved += 1
        if not moved:
            break
    return label


def _contexts(model):
    """Training tokens -> word (null: the end), its first class, the class before it, and how often; folded in each task."""

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        label = m["label"]
        held: list[np.ndarray] = []
        size, ends = 0, np.zeros(CLASSES, np.int64)
        kind = np.dtype([("word", "i8"), ("first", "u1"), ("before", "u1"), ("n", "i8")])

        def fold() -> np.ndarray:
            rows = np.concatenate(held) if len(held) > 1 else held[0]
            # Word and class as one hash, so that a single key is sorted.
            both = mix(rows["word"].view(np.uint64) + rows["before"].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            order = np.argsort(both)
            both = both[order]
            at = np.flatnonzero(np.append(True, both[1:] != both[:-1])[: len(rows)])
            out = rows[order[at]]
            out["n"] = np.add.reduceat(rows["n"][order], at) if len(at) else 0
            return out

        def out(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            for a in range(0, len(rows), 1 << 18):
                r = rows[a : a + (1 << 18)]
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(r["word"])), pa.array(r["first"].astype(np.int16)), pa.array(r["before"].astype(np.int16)), pa.array(np.ascontiguousarray(r["n"]))], names=["word", "first", "before", "n"])

        for batch in batches:
            for lo, hi, word, group, rows in tokens(batch):
                train = np.array([not held_out(i) for i in batch.column(0)[lo:hi].to_pylist()], dtype=bool)
                now, before = with_ends(symbols_of(word, group, m["head"], m["ids"]), rows)
                last = rows[1:] + np.arange(len(rows) - 1)
                inner = np.ones(len(now), dtype=bool)
                inner[last] = False
                ends += np.bincount(label[before[last[train]]], minlength=CLASSES)
                mine = np.repeat(train, np.diff(rows))
                part = np.empty(int(mine.sum()), kind)
                part["word"], part["first"], part["before"], part["n"] = word[mine], label[now[inner]][mine], label[before[inner]][mine], 1
                held.append(part)
                size += len(part)
                if size > FOLD:
                    held = [fold()]
                    size = len(held[0])
                    if size > FOLD // 2:
                        yield from out(held[0])
                        held, size = [], 0
        if held:
            yield from out(fold())
        some = np.flatnonzero(ends)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(some), pa.int64()), pa.array(np.zeros(len(some), np.int16)), pa.array(some.astype(np.int16)), pa.array(ends[some])], names=["word", "first", "before", "n"])

    return contexts


_VECTORS = "word long, c long, first short, before array<short>, n array<long>"


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts sorted by word and class before -> one row for each word, with the classes before it and how often each."""
    names = [x.split(" ")[0] for x in _VECTORS.split(", ")]

    def out(word, first, before, n) -> pa.RecordBatch:
        at = np.flatnonzero(np.append(True, (word[1:] != word[:-1]) | (before[1:] != before[:-1]))[: len(word)])
        word, first, before, n = word[at], first[at], before[at], np.add.reduceat(n, at)
        start = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        offsets = pa.array(np.append(start, len(word)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (before, n)]
        return pa.RecordBatch.from_arrays([pa.array(word[start]), pa.array(np.add.reduceat(n, start)), pa.array(first[start]), *lists], names=names)

    held = None
    for batch in batches:
        cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
        cols = cols if held is None else [np.append(h, c) for h, c in zip(held, cols)]
        if not len(cols[0]):
            continue
        cut = int(np.searchsorted(cols[0], cols[0][-1], "left"))  # the last word may go on
        if cut:
            yield out(*[c[:cut] for c in cols])
        held = [c[cut:] for c in cols]
        if len(held[0]) > 4 * CLASSES * CLASSES:  # a frequent word: its counts are enough
            sums = np.bincount(held[2], weights=held[3], minlength=CLASSES)
            some = np.flatnonzero(sums)
            held = [np.full(len(some), held[0][0]), np.full(len(some), held[1][0], np.int16), some.astype(np.int16), sums[some].astype(np.int64)]
    if held is not None:
        yield out(*held)


def moved(word: np.ndarray, c: np.ndarray, label: np.ndarray, at: np.ndarray, before: np.ndarray, n: np.ndarray, pairs: np.ndarray, turn: int) -> np.ndarray:
    """New classes of words after a round. Word i follows class before[k] n[k] times, for k in at[i] .. at[i + 1].

    pairs[g, h] counts class bigrams with every word in its present class. Taking a word into a class, or out of its own,
    changes the likelihood by terms of that class's column and total alone; equal terms are computed once.
    """
    if not len(word):
        return label
    size = pairs.sum(axis=0)
    pair, own = np.unique(before.astype(np.int64) << 40 | n, return_inverse=True)
    column, times = pairs[pair >> 40], (pair & ((1 << 40) - 1)).astype(float)[:, None]
    total, mine = np.unique(c, return_inverse=True)
    total = total.astype(float)[:, None]
    gain, loss = _xlogx(column + times) - _xlogx(column), _xlogx(column) - _xlogx(np.maximum(column - times, 0))
    more, less = _xlogx(size + total) - _xlogx(size), _xlogx(size) - _xlogx(np.maximum(size - total, 0))

    def best_of(into: np.ndarray, stay: np.ndarray, label: np.ndarray) -> np.ndarray:
        rows = np.arange(len(label))
        into[:, 0] = -np.inf  # the end's own class
        into[rows, label] = stay
        best = into.argmax(axis=1)
        return np.where(into[rows, best] > stay + 1e-9, best, label)

    out = label.copy()
    alone = np.diff(at) == 1
    # Most words follow a single class: of those with equal counts and class one is looked at.
    one = np.flatnonzero(alone)
    kind, where = np.unique(own[at[one]] * CLASSES + label[one], return_inverse=True)
    k, l = kind // CLASSES, kind % CLASSES
    of = np.searchsorted(total[:, 0], times[k, 0])  # such a word's count is that of its only class
    out[one] = best_of(gain[k] - more[of], loss[k, l] - less[of, l], l)[where]
    many = np.flatnonzero(~alone)
    if len(many):
        n_of = at[many + 1] - at[many]
        start = np.append(0, np.cumsum(n_of)[:-1])
        each = own[np.repeat(at[many] - start, n_of) + np.arange(n_of.sum())]
        into = np.add.reduceat(gain[each], start) - more[mine[many]]
        stay = np.add.reduceat(loss[each, np.repeat(label[many], n_of)], start) - less[mine[many], label[many]]
        out[many] = best_of(into, stay, label[many])
    allowed = ((mix(word.view(np.uint64)) >> np.uint64(40)) & np.uint64(1)).astype(np.int64) == turn % 2
    return np.where(allowed, out, label)


def _labelled(batch: pa.RecordBatch, rounds: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Words of a batch of vectors with their classes after all rounds so far."""
    word, c, first = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
    lists = [batch.column(i) for i in (3, 4)]
    at = lists[0].offsets.to_numpy().astype(np.int64)
    before, n = (x.values.to_numpy(zero_copy_only=False)[at[0] : at[-1]] for x in lists)
    at = at - at[0]
    label = first.astype(np.int64)
    for turn, pairs in enumerate(rounds):
        label = moved(word, c, label, at, before, n, pairs, turn)
    return word, c, label, at, before, n


def _class_bigrams(rounds: list[np.ndarray]):
    def bigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, kinds = np.zeros(CLASSES * CLASSES, np.int64), np.zeros(CLASSES, np.int64)
        for batch in batches:
            word, _, label, at, before, n = _labelled(batch, rounds)
            np.add.at(total, before.astype(np.int64) * CLASSES + np.repeat(label, np.diff(at)), n)
            kinds += np.bincount(label, minlength=CLASSES)
        cells, k = np.flatnonzero(total), np.flatnonzero(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(cells, -1 - k).astype(np.int32)), pa.array(np.append(total[cells], kinds[k]))], names=["cell", "n"])

    return bigrams


def _classes(rounds: list[np.ndarray]):
    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, c, label, *_ = _labelled(batch, rounds)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(c), pa.array(label.astype(np.int16))], names=["word", "c", "h"])

    return classes


def exchange_words(vectors: DataFrame, ends: np.ndarray, rounds: int = WORD_ROUNDS) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Matrices of the rounds; class bigrams and number of words of each class after the last one. ``ends``: classes before ends."""
    done: list[np.ndarray] = []
    while True:
        pairs, kinds = np.zeros(CLASSES * CLASSES), np.zeros(CLASSES)
        for r in vectors.mapInArrow(tidy(_class_bigrams(done)), "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
            if r["cell"] >= 0:
                pairs[r["cell"]] = r["n"]
            else:
                kinds[-1 - r["cell"]] = r["n"]
        pairs = pairs.reshape(CLASSES, CLASSES)
        pairs[:, 0] += ends
        if len(done) == rounds:
            return done, pairs, kinds
        done.append(pairs)


def class_model(pairs: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log10 P(h | g), and for each h the count that a word's share is taken of: a class has a word more than were seen.

    P(word | h) = (c + 0.5) / share[h], for an unseen word with c = 0; the end is alone in class 0.
    """
    size = pairs.sum(axis=0)
    unigram = (size + 1.0) / (size + 1.0).sum()
    step = (pairs + BACKOFF * unigram) / (pairs.sum(axis=1, keepdims=True) + BACKOFF)
    return np.log10(step), size + 0.5 * (kinds + 1)


def _score(model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        label, step, share = m["label"], m["step"], np.log10(m["share"])
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            for lo, hi, word, group, rows in tokens(batch):
                ids = batch.column(0)[lo:hi]
                now, before = with_ends(symbols_of(word, group, m["head"], m["ids"]), rows)
                last = rows[1:] + np.arange(len(rows) - 1)
                inner = np.ones(len(now), dtype=bool)
                inner[last] = False
                total = lambda x: np.diff(np.append(0.0, np.cumsum(x))[rows])
                g, first = label[before[inner]], label[now[inner]]
                at = np.minimum(np.searchsorted(m["words"], word), max(0, len(m["words"]) - 1))
                found = m["words"][at] == word if len(m["words"]) else np.zeros(len(word), bool)
                # What isn't broadcast counts as unseen here; the join with the vocabulary adds the difference.
                c, h = np.zeros(len(word)), first
                if len(m["words"]):
                    c, h = np.where(found, m["c"][at], 0), np.where(found, m["h"][at], first)
                n = np.diff(rows) + 1
                base = total(np.log10(c + 1.0)) + m["end_log"] - n * m["all_log"]
                own = total(step[g, h] + np.log10(c + 0.5) - share[h]) + step[label[before[last]], 0]
                rare = ~found
                rare_at = pa.array(np.append(0, np.cumsum(rare))[rows].astype(np.int32))
                lists = [pa.ListArray.from_arrays(rare_at, x) for x in (pa.array(word[rare]), pa.array((g[rare] * CLASSES + first[rare]).astype(np.int16)))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + hi - lo)),
                        ids,
                        pa.array([held_out(i) for i in ids.to_pylist()], type=pa.bool_()),
                        pa.array(n, type=pa.int64()),
                        pa.array(np.diff(np.append(0, np.cumsum(found))[rows]) + int(m["end_known"]), type=pa.int64()),
                        pa.array(base, type=pa.float64()),
                        pa.array(own, type=pa.float64()),
                        *lists,
                    ],
                    names=["row", "doc", "held_out", "n_tokens", "n_known", "base_score", "score", "rare", "code"],
                )
                row += hi - lo

    return score


def most_frequent(vocabulary: DataFrame, limit: int):
    """At most ``limit`` rows of the vocabulary, sorted by count: those above a level that only few reach, and of the words
    at that level, if there is room, a part told by their hashes."""
    level = F.floor(F.log2("c") * 8).cast("int")
    room, least, part = limit, None, 0.0
    for r in vocabulary.groupBy(level.alias("level")).count().orderBy(F.col("level").desc()).collect():
        least = r["level"]
        if r["count"] > room:
            part = max(0.0, (room - 4 * room**0.5) / r["count"])
            break
        room, part = room - r["count"], 1.0
    lot = F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int(part * (1 << 20))
    some = vocabulary.limit(0) if least is None else vocabulary.where((level > least) | ((level == least) & lot))
    found = some.limit(limit).toArrow()
    word, c = (found.column(n).to_numpy() for n in ("word", "c"))
    order = np.lexsort((word, -c))
    return found.take(pa.array(order))


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    prepare(spark)
    rows = pick(docs, doc=f"{id_col} long", text=f"{text_col} string")
    counted = rows.mapInArrow(tidy(_count), "word long, ending int, c long")
    vocabulary = durable(counted.groupBy("word").agg(F.sum("c").alias("c")))
    texts = rows.groupBy((F.pmod(F.crc32(F.coalesce(F.col("doc").cast("string"), F.lit("")).cast("binary")), F.lit(7)) == 2).alias("h")).count().collect()
    trained = sum(r["count"] for r in texts if not r["h"])
    words = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    total, distinct = words[0] + trained, words[1] + (1 if trained else 0)

    # The context map g.
    head = np.sort(most_frequent(vocabulary, HEAD).column("word").to_numpy())
    ids = np.arange(len(head))
    pairs = rows.mapInArrow(tidy(_bigrams(head, ids)), "pair int, c long").groupBy("pair").agg(F.sum("c").alias("c")).toArrow()
    counts = np.zeros(SYMBOLS * SYMBOLS)
    counts[pairs.column("pair").to_numpy()] = pairs.column("c").to_numpy()
    label = exchange(counts.reshape(SYMBOLS, SYMBOLS))

    # The map h of the whole vocabulary.
    model = spark.sparkContext.broadcast({"head": head, "ids": ids, "label": label})
    contexts = rows.mapInArrow(tidy(_contexts(model)), "word long, first short, before short, n long")
    sorted_ = contexts.repartition("word").sortWithinPartitions("word", "before")
    # A null word is an end: these few counts come out as rows of their own.
    found = durable(sorted_.mapInArrow(tidy(_with_ends_apart), _VECTORS))
    ends = np.zeros(CLASSES)
    for r in found.where("word is null").collect():
        for g, n in zip(r["before"], r["n"]):
            ends[g] += n
    vectors = found.where("word is not null")
    rounds, pairs, kinds = exchange_words(vectors, ends)
    step, share = class_model(pairs, kinds)
    classes = durable(vectors.mapInArrow(tidy(_classes(rounds)), "word long, c long, h short"))

    often = most_frequent(classes, LOOKUP)
    by_word = np.argsort(often.column("word").to_numpy())
    often = {n: often.column(n).to_numpy()[by_word] for n in ("word", "c", "h")}
    model = spark.sparkContext.broadcast(
        {
            "head": head, "ids": ids, "label": label, "step": step, "share": share, "words": often["word"], "c": often["c"], "h": often["h"].astype(np.int64),
            "all_log": float(np.log10(total + distinct + 1.0)), "end_log": float(np.log10(trained + 1.0)), "end_known": trained > 0,
        }
    )
    schema = "row long, doc long, held_out boolean, n_tokens long, n_known long, base_score double, score double, rare array<long>, code array<short>"
    scored = durable(rows.mapInArrow(tidy(_score(model)), schema))
    literal = lambda x: F.array(*[F.lit(float(v)) for v in np.ravel(x)])
    at = lambda x, k: F.get(literal(x), k.cast("int"))
    each = scored.select("row", F.explode(F.arrays_zip("rare", "code")).alias("t")).select("row", F.col("t.rare").alias("word"), F.col("t.code").cast("int").alias("code"))
    known = each.join(classes, "word")
    g, first = F.expr(f"code div {CLASSES}"), F.col("code") % CLASSES
    seen = at(step, g * CLASSES + F.col("h")) + F.log10(F.col("c") + 0.5) - at(np.log10(share), F.col("h"))
    unseen = at(step, F.col("code")) + F.lit(float(np.log10(0.5))) - at(np.log10(share), first)
    rare = known.groupBy("row").agg(F.sum(F.log10(F.col("c") + 1)).alias("more"), F.sum(seen - unseen).alias("gain"), F.count("*").alias("known"))
    out = scored.drop("rare", "code").join(rare, "row", "left")
    zero = lambda x: F.coalesce(x, F.lit(0))
    return out.select("doc", "held_out", "n_tokens", (F.col("n_known") + zero("known")).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), (F.col("base_score") + zero("more")).alias("base_score"), (F.col("score") + zero("gain")).alias("score"))


def _with_ends_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """_vectors() over the words; the counts of ends, which have no word, as rows without one."""
    ends = np.zeros(CLASSES, np.int64)

    def words() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            null = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            if null.any():
                np.add.at(ends, batch.column(2).to_numpy(zero_copy_only=False)[null], batch.column(3).to_numpy(zero_copy_only=False)[null])
                batch = batch.filter(pa.array(~null))
            yield batch

    yield from _vectors(words())
    if ends.any():
        some = np.flatnonzero(ends)
        one = pa.array([0, len(some)], type=pa.int32())
        lists = [pa.ListArray.from_arrays(one, pa.array(x)) for x in (some.astype(np.int16), ends[some])]
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.array([int(ends.sum())]), pa.array([0], type=pa.int16()), *lists], names=[x.split(" ")[0] for x in _VECTORS.split(", ")])
