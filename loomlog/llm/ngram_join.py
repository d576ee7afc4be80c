"""N-gram Jaccard self-join by T-occurrence search (DivideSkip), as links between classes of equal shingle sets.

1. A scan turns each text into its set of 5-word shingles (64-bit hashes). Documents with equal sets form a class; its
   number is a hash of the set, so copies never meet as pairs. A second hash beside it tells sets apart whose numbers
   are equal by chance: all but one of them get another number. The same scan counts shingles in a sketch of fixed
   size, one for each task, and the sketches are added.
2. Shingles are ordered by hash, those that the sketch shows to be frequent last (any order is exact, this one keeps
   lists short). Two sets of Jaccard similarity t share a shingle among their first n - ceil(t n) + 1, so only those are
   posted to inverted lists. A posting stays only if its list has another one whose size and position leave room for a
   link: lists are read whole where they are sorted, heavy ones, which are dealt out, by a histogram of their sizes. So
   texts that share less than the threshold, however many, leave no postings on the lists of what they share.
3. Rounds of pivots: the first classes of every list are its pivots, one in the first round, then four times as many.
   A pivot is paired with the list's later classes unless both already belong to one component, sizes differ too
   much, or the positions in both sets leave too little room (exact for the first common shingle). A list is done
   when its classes are in one component or all its pairs were made: large groups of near copies collapse after
   their first pivots instead of meeting pair by pair, and no link between components is lost. Near copies share many
   lists with many pivots, so a round goes by turns: each class asks its first pivot, later the others that it is not
   yet in one component with.
4. T-occurrence search: the classes that a list's pivots ask for are the records of inverted lists over their whole
   sets (blocks of about BLOCK records), and the list's pivots are searched in them by DivideSkip: short
   inverted lists are merged by a heap, the long ones are probed by binary search for what the heap counted often
   enough, and classes that reach the overlap are links. A block hands on those that connect what it had apart.
5. Components of the links, and the smallest document of each.

Hot lists are known from the sketch and dealt out in parts of some hundred classes, their pivots are found with partial limits;
nothing grows on the driver but the sketch and a filter, whose sizes are bounded. Texts never move: sets of classes that
share a list are read again from the rows that a filter lets pass, so what is shuffled are postings, pairs and these
sets. All intermediate tables are reliable checkpoints.

Defined results: a text with fewer words than the shingle has its whole sequence as one shingle; null, empty and
wordless texts have none, and form a component alone; repeated rows are equal texts; a null identifier is never the
smallest unless a component has no other; ties don't occur, as every link counts; a very long text is one set, held by
one task at a time; further columns are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomlog.llm.common import BROADCAST_ROWS, discard, durable, lowered, pick, prepare, salted_totals, settled, swept, tidy, utf8, words_of, written
from loomlog.llm.components import components, united
from loomlog.llm.hashing import mix, range_hashes, shingle_hashes
from loomlog.llm.membership import Members, key, may_hold

#: Words of a shingle; the threshold is NUM / DEN.
WORDS, NUM, DEN = 5, 3, 4
#: Shingles that the sketch puts at FREQUENT classes or more come last in the order; the lists of those 32 times
#: as frequent (HEAVY_RANK: 1 + 12 * log2(32)) are dealt out in two parts, with every doubling in twice as many, up to
#: 2^MAX_PARTS.
FREQUENT, HEAVY_RANK, MAX_PARTS = 16, 61, 14
#: Slots of the sketch as a power of two, and rows that a task's sketch is cut into.
SKETCH_BITS, SKETCH_PARTS = 22, 16
#: Candidates of a pivot that are searched in one block, bytes of text taken at a time, growth of the pivots.
BLOCK, PIECE, GROWTH = 256, 1 << 20, 4


def needed(a, b):
    """Twice-scaled overlap rule: sets of sizes a and b are linked if (NUM + DEN) * overlap >= this."""
    return NUM * (a + b)


def shingle_sets(raw: np.ndarray, at: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, ascending distinct shingle hashes) of every row."""
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = min(n, max(lo + 1, int(np.searchsorted(at, at[lo] + PIECE, "right")) - 1))
        part = lowered(raw[at[lo] : at[hi]])
        starts, ends, rows = words_of(part, at[lo : hi + 1] - at[lo])
        found, where = shingle_hashes(range_hashes(part, starts, ends), rows, size)
        where = where.tolist()
        for i in range(hi - lo):
            own = np.sort(found[where[i] : where[i + 1]])
            if len(own) > 1:
                own = own[np.append(True, own[1:] != own[:-1])]
            yield lo + i, own
        lo = hi


def numbers_of(own: np.ndarray) -> tuple[int, int]:
    """A number for a set and another, independent one: equal sets have equal numbers."""
    if not len(own):
        return 0, 0
    mixed = mix(own)
    again = (mixed ^ (mixed >> np.uint64(29))) * (mixed | np.uint64(1))
    return int((mixed.sum(dtype=np.uint64) ^ np.uint64(len(own) * 0x9E3779B97F4A7C15 % (1 << 64))).view(np.int64)), int(again.sum(dtype=np.uint64).view(np.int64))


def class_of(own: np.ndarray) -> int:
    return numbers_of(own)[0]


def check_of(own: np.ndarray) -> int:
    return numbers_of(own)[1]


def renumbered(own: np.ndarray, number: int, again: dict[tuple[int, int], int], shared: set[int]) -> int:
    """The class of a set, where sets of one number have others."""
    return again.get((number, check_of(own)), number) if number in shared else number


_SCAN = "doc long, mark long, n long, class long, check long, part int, counts binary"


def _scan(size: int, bits: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, seen = np.zeros(1 << bits, dtype=np.uint32), set()
        names = [c.split(" ")[0] for c in _SCAN.split(", ")]
        for batch in batches:
            sizes, classes, checks = [], [], []
            for _, own in shingle_sets(*utf8(batch.column("text")), size):
                c, check = numbers_of(own)
                sizes.append(len(own))
                classes.append(c)
                checks.append(check)
                if c not in seen:
                    seen.add(c)
                    np.add.at(sketch, (own >> np.uint64(64 - bits)).astype(np.int64), 1)
            k = batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("mark"), *(pa.array(x, type=pa.int64()) for x in (sizes, classes, checks)), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], names=names)
        parts = np.split(sketch, SKETCH_PARTS)
        k = SKETCH_PARTS
        yield pa.RecordBatch.from_arrays([*(pa.nulls(k, pa.int64()) for _ in range(5)), pa.array(range(k), type=pa.int32()), pa.array([zlib.compress(p.tobytes(), 1) for p in parts], type=pa.binary())], names=names)

    return scan


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            sums[part] = sums.get(part, 0) + np.frombuffer(zlib.decompress(counts), np.uint32).astype(np.int64)
    # Sums stop at what 32 bits hold: beyond, a slot's rank is the highest anyway.
    packed = [zlib.compress(np.minimum(x, 2**32 - 1).astype(np.uint32).tobytes(), 1) for x in sums.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), type=pa.int32()), pa.array(packed, type=pa.binary())], names=["part", "counts"])


def ranks(sketch: np.ndarray, mean: float | None = None) -> np.ndarray:
    """The top byte of an order key for each slot: 0 unless the slot stands out by FREQUENT classes and three deviations.

    What a slot has beside the frequent shingle is about the mean of all slots, so the bound holds at every size.
    """
    mean = float(sketch.mean()) if mean is None else mean
    least = max(float(FREQUENT), 3 * mean**0.5)
    above = np.maximum((sketch - mean) / least, 0)
    return np.where(above < 1, 0, np.minimum(255, 1 + np.floor(12 * np.log2(np.maximum(above, 1))))).astype(np.uint8)


def _all_ranks(sums: dict[int, bytes]) -> np.ndarray:
    """Ranks of all slots from the compressed parts of the sketch, part by part."""
    width = (1 << SKETCH_BITS) // SKETCH_PARTS
    own = lambda part: np.frombuffer(zlib.decompress(sums[part]), np.uint32) if part in sums else np.zeros(width, np.uint32)
    mean = sum(float(own(p).sum(dtype=np.float64)) for p in range(SKETCH_PARTS)) / (1 << SKETCH_BITS)
    return np.concatenate([ranks(own(p), mean) for p in range(SKETCH_PARTS)])


def heavy(key: np.ndarray) -> np.ndarray:
    return key.view(np.uint64) >> np.uint64(56) >= np.uint64(HEAVY_RANK)


def order_keys(own: np.ndarray, top: np.ndarray, bits: int) -> np.ndarray:
    """Keys of a set in the common order: the slot's rank, then 56 bits of the hash."""
    return np.sort(top[(own >> np.uint64(64 - bits)).astype(np.int64)].astype(np.uint64) << np.uint64(56) | ((own << np.uint64(20)) >> np.uint64(8)) | (own >> np.uint64(64 - 8)))


def _post(size: int, bits: int, ranked, again: dict[tuple[int, int], int]):
    twice = {c for c, _ in again}

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top, seen = ranked.value, set()
        for batch in batches:
            keys, classes, sizes = [], [], []
            for _, own in shingle_sets(*utf8(batch.column("text")), size):
                n = len(own)
                if n and (c := renumbered(own, class_of(own), again, twice)) not in seen:
                    seen.add(c)
                    keys.append(order_keys(own, top, bits)[: n - (NUM * n + DEN - 1) // DEN + 1])
                    classes.append(c)
                    sizes.append(n)
            if keys:
                lengths = np.array([len(k) for k in keys])
                at = np.arange(lengths.sum()) - np.repeat(np.append(0, np.cumsum(lengths)[:-1]), lengths)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.repeat(np.array(classes, np.int64), lengths)), pa.array(np.repeat(np.array(sizes, np.int32), lengths)), pa.array(at.astype(np.int32))], names=["key", "class", "n", "at"])

    return post


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings sorted by key and class -> those of lists with two classes or more, each class once.

    Of heavy lists a task has only a part, so nothing is known about their other classes: all their postings stay.
    """
    held = None  # the last row of the batches so far, and whether its list has been handed on
    opened = False
    for batch in batches:
        cols = [batch.column(i).to_numpy() for i in range(4)]
        if held is not None:
            cols = [np.append(h, c) for h, c in zip(held, cols)]
        key, own = cols[0], cols[1]
        if not len(key):
            continue
        fresh = np.append(True, (key[1:] != key[:-1]) | (own[1:] != own[:-1]))
        at = np.flatnonzero(fresh)
        k = key[at]
        like_before = np.append(False, k[1:] == k[:-1])
        like_after = np.append(k[1:] == k[:-1], False)
        keep = like_before | like_after | heavy(k)
        if held is not None and opened:
            keep[0] = False  # it went out with the last batch
        last_open = bool(like_before[-1]) or (len(at) == 1 and opened) or bool(heavy(k[-1:])[0])
        keep[-1] = keep[-1] and last_open
        out = at[keep]
        if len(out):
            out = out[useful(cols[0][out], cols[2][out], cols[3][out])]
        if len(out):
            yield pa.RecordBatch.from_arrays([pa.array(c[out]) for c in cols], names=batch.schema.names)
        held, opened = [c[at[-1] : at[-1] + 1] for c in cols], last_open


def useful(key: np.ndarray, n: np.ndarray, at: np.ndarray) -> np.ndarray:
    """False for postings that fit no other one of their list. The first and last list may be incomplete: they stay.

    A posting at position ``at`` of a set of size n can be the first common one only with sets of at most
    ((NUM + DEN) * (n - at) - NUM * n) / NUM shingles, and at least NUM / DEN of its own.
    """
    n, at = n.astype(np.int64), at.astype(np.int64)
    most = ((NUM + DEN) * (n - at) - NUM * n) // NUM
    run = np.cumsum(np.append(0, key[1:] != key[:-1]))
    starts = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
    sizes = np.diff(np.append(starts, len(run)))

    def of_others(values: np.ndarray) -> np.ndarray:
        """The least value of the other postings of the list."""
        order = np.lexsort((values, run))
        first = order[starts]
        second = order[np.minimum(starts + 1, len(order) - 1)]
        out = np.repeat(values[first], sizes)
        out[first] = np.where(sizes > 1, values[second], np.iinfo(np.int64).max // 2)
        return out

    keep = (of_others(n) <= most) & (-of_others(-most) >= n)
    whole = (run > 0) & (run < run[-1]) & ~heavy(key)
    keep |= ~whole
    # A list that is left with one posting has no pair.
    return keep & (~whole | (np.repeat(np.add.reduceat(keep.astype(np.int64), starts), sizes) > 1))


class DivideSkip:
    """T-occurrence search over the inverted lists of a block of sets."""

    #: Weight of a probe against a step of the heap, in choosing how many lists count as long.
    PROBE = 0.1

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = [len(s) for s in sets]
        tokens = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.lexsort((owner, tokens))
        self.tokens, self.owner = tokens[order], owner[order]

    def search(self, query: np.ndarray) -> list[int]:
        """Sets whose overlap with the query reaches the threshold."""
        lo, hi = np.searchsorted(self.tokens, query, "left"), np.searchsorted(self.tokens, query, "right")
        some = hi > lo
        lists = sorted((self.owner[a:b].tolist() for a, b in zip(lo[some].tolist(), hi[some].tolist())), key=len)
        fits = [n for n in self.sizes if DEN * min(n, len(query)) >= NUM * max(n, len(query))]
        if not fits or not lists:
            return []
        least = -(-needed(min(fits), len(query)) // (NUM + DEN))  # the smallest overlap that can be asked for
        if least > len(lists):
            return []
        n_long = min(least - 1, int(least / (self.PROBE * np.log2(len(lists[-1]) + 1) + 1)))
        short, long_ = lists[: len(lists) - n_long], lists[len(lists) - n_long :]
        out = []
        for record, count in self._merge(short, least - n_long):
            n = self.sizes[record]
            want = needed(n, len(query))
            if DEN * min(n, len(query)) < NUM * max(n, len(query)):
                continue
            left = len(long_)
            for own in long_:
                if (NUM + DEN) * count >= want or (NUM + DEN) * (count + left) < want:
                    break
                i = bisect_left(own, record)
                count += i < len(own) and own[i] == record
                left -= 1
            if (NUM + DEN) * count >= want:
                out.append(record)
        return out

    @staticmethod
    def _merge(lists: list[list[int]], least: int) -> Iterator[tuple[int, int]]:
        """Records in at least ``least`` lists, by a heap that skips what can't be in so many."""
        heap = [(own[0], k, 0) for k, own in enumerate(lists)]
        heapq.heapify(heap)
        while len(heap) >= least:
            record, popped = heap[0][0], []
            while heap and heap[0][0] == record:
                popped.append(heapq.heappop(heap))
            if len(popped) >= least:
                yield record, len(popped)
                for _, k, i in popped:
                    if i + 1 < len(lists[k]):
                        heapq.heappush(heap, (lists[k][i + 1], k, i + 1))
                continue
            # Fewer lists than needed stand here: least - 1 lists may jump to the next record that can still make it.
            while heap and len(popped) < least - 1:
                popped.append(heapq.heappop(heap))
            if not heap:
                return
            jump = heap[0][0]
            for _, k, i in popped:
                if (j := bisect_left(lists[k], jump, i)) < len(lists[k]):
                    heapq.heappush(heap, (lists[k][j], k, j))


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks (list, salt), sorted, their records before their pivots -> links. Records are held, pivots pass by.

    A link is left out if others of its block connect the same two already, so a block has fewer links than sets.
    """
    block, members, sets, index, root = None, [], [], None, {}
    for batch in batches:
        found: list[tuple[int, int]] = []
        for here, salt, asked, own, data in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if (here, salt) != block:
                block, members, sets, index, root = (here, salt), [], [], None, {}
            if not asked:
                members.append(own)
                sets.append(np.frombuffer(data, np.uint64))
            elif members:
                index = index or DivideSkip(sets)
                found += [(own, members[i]) for i in index.search(np.frombuffer(data, np.uint64)) if united(root, own, members[i])]
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], type=pa.int64()) for k in (0, 1)], names=["u", "v"])


def _sets(size: int, again: dict[tuple[int, int], int], passes):
    """Sets of the rows whose key (a, b) the filter lets pass, in the worker that makes them."""
    twice = {c for c, _ in again}

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # rows that are repeated
        for batch in batches:
            classes, data = [], []
            batch = batch.filter(passes(batch.column("a"), batch.column("b")))
            for _, own in shingle_sets(*utf8(batch.column("text")), size):
                if len(own) and (c := renumbered(own, class_of(own), again, twice)) not in seen:
                    seen.add(c)
                    classes.append(c)
                    data.append(own.tobytes())
            for a in range(0, len(classes), 1000):
                yield pa.RecordBatch.from_arrays([pa.array(classes[a : a + 1000], type=pa.int64()), pa.array(data[a : a + 1000], type=pa.binary())], names=["class", "shingles"])

    return sets


#: The largest set that a posting can still be linked with, as SQL.
_MOST = f"({NUM + DEN} * (n - at) - {NUM} * n) div {NUM}"


def _roomy(lists: DataFrame) -> DataFrame:
    """Postings of heavy lists that some other one of the list leaves room for, by size classes of the whole list.

    The histogram has some hundred size classes whatever the list's length; sums and join go by (key, salt).
    """
    is_heavy = F.expr(f"shiftrightunsigned(key, 56) >= {HEAVY_RANK}")
    many = lists.where(is_heavy).withColumns({"most": F.expr(_MOST), "bucket": F.expr("if(n < 64, cast(n as int), 64 + cast(floor(ln(n / 64) * 40) as int))")})
    parts = many.groupBy("key", "salt", "bucket").agg(F.min("n").alias("low"), F.max("most").alias("high"), F.count("*").alias("c"))
    whole = parts.groupBy("key", "bucket").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("c").alias("c"), F.collect_set("salt").alias("salts"))
    whole = whole.groupBy("key").agg(F.collect_list(F.struct("bucket", "low", "high", "c")).alias("sizes"), F.array_distinct(F.flatten(F.collect_list("salts"))).alias("salts"))
    room = F.exists("sizes", lambda x: (x["low"] <= F.col("most")) & (x["high"] >= F.col("n")) & ((x["bucket"] != F.col("bucket")) | (x["c"] > 1)))
    kept = many.join(whole.select("key", "sizes", F.explode("salts").alias("salt")), ["key", "salt"]).where(room)
    return lists.where(~is_heavy).unionByName(settled(kept.select(*lists.columns))[0])


def _links(rows: DataFrame, classes: DataFrame, lists: DataFrame, size: int, again: dict) -> DataFrame | None:
    """Links u (pivot), v that connect every component, or None where there are none. Each round writes what
    is left of the lists and deletes what the round before wrote; the lists themselves stay."""
    wanted = lists.select("class").distinct()
    best, n = settled(classes.join(wanted, "class", "left_semi").select(key("doc", "mark").alias("k")).select("k.a", "k.b"))
    if not n:
        return None
    # What passes besides the wanted rows is a set that no pair asks for.
    keyed = rows.withColumn("k", key("doc", "mark")).select("k.a", "k.b", "text")
    sets = durable(keyed.mapInArrow(tidy(_sets(size, again, Members(best, n).passing())), "class long, shingles binary"))

    links = done = path = None
    low, high, active = 0, 1, lists
    while True:
        rank = F.row_number().over(Window.partitionBy("key").orderBy("class"))
        first = active.withColumn("rank", rank).where(F.col("rank") <= high).where(F.col("rank") > low)
        pivots = first.select("key", *[F.col(c).alias(f"p_{c}") for c in ("class", "n", "at", "label")])
        parts = active.select("key", "salt").distinct()
        both = active.join(pivots.join(parts, "key"), ["key", "salt"]).where("class > p_class and label != p_label")
        fits = F.expr(f"{DEN} * least(n, p_n) >= {NUM} * greatest(n, p_n) and {NUM + DEN} * least(n - at, p_n - p_at) >= {NUM} * (n + p_n)")
        pairs = both.where(fits).groupBy(F.col("p_class").alias("u"), F.col("class").alias("v")).agg(F.min("key").alias("list"))
        pairs = pairs if done is None else pairs.join(done, ["u", "v"], "left_anti")
        pairs, made = settled(pairs.withColumn("turn", F.row_number().over(Window.partitionBy("v").orderBy("u"))))
        labels, asking = None, pairs.where("turn = 1").count()
        # Where that is much less, each class asks its first pivot before the others.
        for turn in (["turn = 1", "turn > 1"] if made > 2 * asking else ["true"]) if made else []:
            now = pairs.where(turn)
            if labels is not None:
                now, made = settled(_apart(now, labels))
                if not made:
                    break
            asked = now.select("u", "v")
            done = asked if done is None else settled(done.unionByName(asked))[0]
            found, hits = _searched(now, sets)
            swept(rows.sparkSession)
            if hits:
                links = found if links is None else settled(links.unionByName(found))[0]
                labels, named = settled(components(links).select(F.col("node").alias("class"), F.col("root").alias("new")))
                labels = F.broadcast(labels) if named <= BROADCAST_ROWS else labels
        if labels is not None:
            active = active.join(labels, "class", "left").withColumn("label", F.coalesce("new", "label")).drop("new")
        low, high = high, high * GROWTH
        active, left = written(_open(active, low))
        if path is not None:
            discard(rows.sparkSession, path)
        path = left
        swept(rows.sparkSession)
        if active.isEmpty():
            discard(rows.sparkSession, path)
            return links


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs u, v of classes that are not in one component."""
    of = lambda c: labels.select(F.col("class").alias(c), F.col("new").alias(f"{c}_new"))
    return pairs.join(of("u"), "u", "left").join(of("v"), "v", "left").where("coalesce(u_new, u) != coalesce(v_new, v)").select(*pairs.columns)


def _open(lists: DataFrame, done: int) -> DataFrame:
    """Lists with more than ``done`` classes, not all in one component. Sums and join go by (key, salt)."""
    parts = lists.groupBy("key", "salt").agg(F.count("*").alias("c"), F.min("label").alias("a"), F.max("label").alias("b"))
    whole = parts.groupBy("key").agg(F.sum("c").alias("c"), F.min("a").alias("a"), F.max("b").alias("b"), F.collect_set("salt").alias("salts"))
    left = whole.where((F.col("c") > done) & (F.col("a") != F.col("b"))).select("key", F.explode("salts").alias("salt"))
    return lists.join(left, ["key", "salt"], "left_semi")


def _searched(pairs: DataFrame, sets: DataFrame) -> tuple[DataFrame, int]:
    """Pairs (pivot u, candidate v, the list where they met): links among what the pivots of each list ask for."""
    # Blocks of a list hold about BLOCK of its records and as many of its pivots.
    count = pairs.groupBy("list").agg(*[F.greatest(F.lit(1), F.expr(f"cast(ceil(approx_count_distinct({c}) / {BLOCK}) as bigint)")).alias(f"of_{c}") for c in ("u", "v")])
    salted = pairs.join(count, "list").withColumn("salt", F.expr("pmod(xxhash64(v), of_v) + of_v * pmod(xxhash64(u), of_u)"))
    of = lambda name, asked: salted.select("list", "salt", F.lit(asked).alias("asked"), F.col(name).alias("class"))
    needs, n = settled(of("v", False).unionByName(of("u", True)).distinct())
    members = None
    if n <= BROADCAST_ROWS:
        here = sets.join(F.broadcast(needs), "class")
    else:  # both are shuffled, the sets once and only those that are asked for
        members = Members(needs.select("class").distinct().select(key("class").alias("k")).select("k.a", "k.b"))
        here = may_hold(sets, members, "class").join(needs, "class")
    here = here.select("list", "salt", "asked", F.col("class").alias("own"), "shingles")
    found = settled(here.repartition("list", "salt").sortWithinPartitions("list", "salt", "asked").mapInArrow(tidy(_search), "u long, v long"))
    if members is not None:
        members.free()
    return found


def _numbered_apart(scanned: DataFrame, classes: DataFrame) -> tuple[DataFrame, dict[tuple[int, int], int]]:
    """Gives different sets of one number different numbers: hardly any among 10^10, so they are collected."""
    twice = classes.where("low != high").select("class")
    if twice.isEmpty():
        return scanned, {}
    some = scanned.join(F.broadcast(twice), "class").select("class", "check").distinct().collect()
    least = {c: min(k for d, k in some if d == c) for c, _ in some}
    again = {(c, k): int(mix(np.array([c, k], np.int64).view(np.uint64)).sum(dtype=np.uint64).view(np.int64)) for c, k in some if k != least[c]}
    names = scanned.sparkSession.createDataFrame([(*k, v) for k, v in again.items()], "class long, check long, new long")
    return scanned.join(F.broadcast(names), ["class", "check"], "left").withColumn("class", F.coalesce("new", "class")).drop("new"), again


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WORDS) -> DataFrame:
    """One row per input row: doc, mark (hash of the text), n_shingles, component (smallest reachable doc) and root (a
    number of the component, null without shingles)."""
    spark = docs.sparkSession
    prepare(spark)
    rows = pick(docs, doc=f"{id_col} long", text=f"{text_col} string").withColumn("mark", F.xxhash64("text"))
    both = durable(rows.mapInArrow(tidy(_scan(size, SKETCH_BITS)), _SCAN))
    scanned = both.where("part is null").select("doc", "mark", "n", "class", "check")
    of_class = lambda found: durable(found.where("n > 0").groupBy("class").agg(F.min(F.struct("doc", "mark")).alias("r"), F.min("check").alias("low"), F.max("check").alias("high")).select("class", "r.doc", "r.mark", "low", "high"))
    classes = of_class(scanned)
    scanned, again = _numbered_apart(scanned, classes)
    classes = of_class(scanned) if again else classes
    sums = {}
    for r in both.where("part is not null").select("part", "counts").repartition(SKETCH_PARTS, "part").mapInArrow(_add, "part int, counts binary").collect():
        sums[r["part"]] = r["counts"]
    shared = spark.sparkContext.broadcast(_all_ranks(sums))
    postings = rows.mapInArrow(tidy(_post(size, SKETCH_BITS, shared, again)), "key long, class long, n int, at int")
    # The top byte of a key is its slot's rank, twelve to a doubling: a heavy list's number of parts follows from it.
    salt = F.expr(f"if(shiftrightunsigned(key, 56) >= {HEAVY_RANK}, pmod(class, shiftleft(1L, cast(least({MAX_PARTS}, 1 + (shiftrightunsigned(key, 56) - {HEAVY_RANK}) div 12) as int))), 0L)")
    lists = postings.repartition("key", salt).sortWithinPartitions("key", "class").mapInArrow(tidy(_lists), "key long, class long, n int, at int")
    # The largest intermediate result: a table is smaller than a checkpoint.
    lists = _roomy(written(lists.withColumn("label", F.col("class")).withColumn("salt", salt))[0])
    swept(spark)
    links = _links(rows, classes, lists, size, again)

    rooted = scanned.drop("check").withColumn("root", F.col("class"))
    if links is not None:
        roots, named = settled(components(links).select(F.col("node").alias("class"), F.col("root").alias("top")))
        roots = F.broadcast(roots) if named <= BROADCAST_ROWS else roots
        rooted = rooted.join(roots, "class", "left").withColumn("root", F.coalesce("top", "root")).drop("top")
    full = rooted.where("n > 0")
    least = salted_totals(full, "root", "doc", {"component": F.col("doc")}, how=F.min)
    full = full.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(64))).join(least, (F.col("root") == F.col("total_key")) & (F.col("salt") == F.col("total_salt")))
    out = full.select("doc", "mark", F.col("n").alias("n_shingles"), "component", "root")
    return out.unionByName(scanned.where("n = 0").select("doc", "mark", F.col("n").alias("n_shingles"), F.col("doc").alias("component"), F.lit(None).cast("long").alias("root")))
