"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

1. Documents are dealt into shards by a seeded hash; (source, shard) is a cell, and its words are cut into blocks of
   about ``block_words``. Only sums per cell reach the driver: at most MAX_CELLS, however many documents and sources
   there are (a source has one cell at least). A cell's documents are sorted and summed as a stream that may spill.
2. Targets in words follow the weights, up to ``max_repeat`` times a source's own words. Blocks go to sources by
   highest quotients v / (2k + 1), then each source's blocks to its shards by the same rule: integer quotas per cell.
3. In each cell documents stand in a seeded order. A quota of q blocks of n is q // n whole passes and one seeded,
   circular run of q % n blocks; what a document gives follows from its position, so no block is ever a row.

Hot sources are spread over all shards, the running sum of a cell is a streaming window, and reruns agree, since
every choice is a hash of identifiers, the seed and sums over whole tables.

Defined results: null text has size 0; a null source is a source of its own, ranked last; repeated rows count one by
one; null identifiers are dealt by their texts; equal quotients go to the first source or shard, equal places in a
cell's order to rows that are equal in all that decides; a very long text is cut like others; further columns are
ignored, whatever their names; an empty table, or one without words, takes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlog.llm.common import pick, prepare, tidy, utf8, word_counts, words_of

#: Documents of a shard on average, and the most cells of all sources.
SHARD_DOCS, MAX_CELLS = 1000, 1 << 18
BLOCK_WORDS = 32
#: The weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)


def targets(sizes: list[int], weights: list[float], most: float) -> list[float]:
    """Shares of all words by weight, none above ``most`` times its size; the excess is shared again by weight."""
    total, capped = sum(sizes), set()
    while True:
        rest = total - sum(most * sizes[i] for i in capped)
        weight = sum(w for i, w in enumerate(weights) if i not in capped)
        out = [most * s if i in capped else rest * weights[i] / weight for i, s in enumerate(sizes)]
        above = {i for i, s in enumerate(sizes) if i not in capped and out[i] > most * s}
        if not above:
            return [float(x) for x in out]
        capped |= above


def sainte_lague(votes: np.ndarray, seats: int, caps: np.ndarray) -> np.ndarray:
    """Seats by highest quotients votes / (2k + 1), ties to the first, none above its cap.

    The seats that any order of the quotients must grant are found by bisecting the divisor; the few at the edge
    are then granted one by one.
    """
    votes, caps = np.asarray(votes, float), np.asarray(caps, np.int64)
    caps = np.where(votes > 0, caps, 0)
    seats = min(int(seats), int(caps.sum()))
    granted = lambda d: np.minimum(np.floor(votes / d + 0.5), caps).astype(np.int64)
    if seats <= 0 or not len(votes):
        return np.zeros(len(votes), np.int64)
    low, high = 1e-12, float(2 * votes.max() + 1)  # granted(low) >= seats > granted(high)
    while granted(low).sum() < seats:
        low /= 1e6
    for _ in range(200):
        mid = (low + high) / 2
        if granted(mid).sum() >= seats:
            low = mid
        else:
            high = mid
    out = granted(high)
    import heapq

    heap = [(-votes[i] / (2 * int(out[i]) + 1), i) for i in range(len(votes)) if out[i] < caps[i]]
    heapq.heapify(heap)
    for _ in range(seats - int(out.sum())):
        _, i = heapq.heappop(heap)
        out[i] += 1
        if out[i] < caps[i]:
            heapq.heappush(heap, (-votes[i] / (2 * int(out[i]) + 1), i))
    return out


def _sizes(schema: T.StructType):
    names = schema.names

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [pa.array(word_counts(*utf8(batch.column("text"))), type=pa.int64()) if n == "size" else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return sizes


def with_sizes(docs: DataFrame, carried: list[str]) -> DataFrame:
    """doc, source, mark, size and the carried columns; ``docs`` has doc, source, text."""
    docs = docs.withColumn("mark", F.xxhash64("text"))
    schema = T.StructType([x for x in docs.schema if x.name in ("doc", "source", "mark", *carried)] + [T.StructField("size", T.LongType())])
    return docs.mapInArrow(tidy(_sizes(schema)), schema)


def quotas(cells: list[tuple[str | None, int, int]], weights=WEIGHTS, most: int = 3, block_words: int = BLOCK_WORDS, seed: int = 0) -> list[tuple]:
    """(source, shard, words) -> rows (source, shard, source_size, target, words, blocks, passes, first, last).

    Of the circular run of blocks [first, last), last may exceed ``blocks``.
    """
    sources = sorted({c[0] for c in cells}, key=lambda s: (s is None, s or ""))
    at = {s: i for i, s in enumerate(sources)}
    words = [0] * len(sources)
    for s, _, n in cells:
        words[at[s]] += n
    if not sum(words):
        return [(s, h, words[at[s]], 0.0, n, 0, 0, 0, 0) for s, h, n in cells]
    goal = targets(words, [float(weights[i % len(weights)]) for i in range(len(sources))], most)
    cells = sorted(cells, key=lambda c: (at[c[0]], c[1]))
    blocks = np.array([max(1, round(n / block_words)) if n else 0 for _, _, n in cells], np.int64)
    own = np.array([at[c[0]] for c in cells])
    rate = np.array([g / w if w else 0.0 for g, w in zip(goal, words)])
    per_source = np.bincount(own, weights=blocks, minlength=len(sources))
    seats = sainte_lague(rate * per_source, round(float((rate * per_source).sum())), most * per_source)
    out = []
    for i, s in enumerate(sources):
        mine = np.flatnonzero(own == i)
        got = sainte_lague(rate[i] * blocks[mine], int(seats[i]), most * blocks[mine])
        for k, q in zip(mine.tolist(), got.tolist()):
            n = int(blocks[k])
            passes, run = (q // n, q % n) if n else (0, 0)
            first = int(np.random.default_rng([seed, i, cells[k][1]]).integers(0, n)) if run else 0
            out.append((s, cells[k][1], words[i], goal[i], cells[k][2], n, passes, first, first + run))
    return out


_QUOTA = "cell_source string, cell_shard long, source_size long, target double, words long, blocks long, passes long, first long, last long"
#: Cells that are broadcast at most (about 100 bytes each); beyond, they are joined by a shuffle.
BROADCAST_CELLS = 100_000


def _source_key(column: str):
    """The source as a key that is never null, so that window and join share one partitioning."""
    return F.coalesce(F.concat(F.lit("s"), F.col(column)), F.lit("n"))


def mix(sized: DataFrame, weights=WEIGHTS, max_repeat: int = 3, block_words: int = BLOCK_WORDS, seed: int = 17, sums_of: DataFrame | None = None) -> DataFrame:
    """Adds source_size, target, passes, cut1_from, cut1_to, cut2_from, cut2_to (word ranges of the run) and taken.

    ``sized`` has doc, source, mark (a hash of the text), size; ``sums_of`` may be a cheaper frame with the same rows for
    the sums.
    """
    spark = sized.sparkSession
    sums_of = sized if sums_of is None else sums_of
    n, sources = sums_of.agg(F.count("*"), F.approx_count_distinct("source")).first()
    shards = max(1, min(MAX_CELLS // (int(1.2 * sources) + 1), -(-n // SHARD_DOCS)))
    shard = F.pmod(F.xxhash64(F.lit(seed), F.coalesce("doc", "mark")), F.lit(shards))
    sums = sums_of.groupBy("source", shard.alias("shard")).agg(F.sum("size").alias("words")).collect()
    rows = quotas([tuple(r) for r in sums], weights, max_repeat, block_words, seed)
    plan = spark.createDataFrame(rows, _QUOTA)
    plan = plan.withColumns({"cell": _source_key("cell_source"), "shard": F.col("cell_shard")}).drop("cell_source", "cell_shard")
    plan = F.broadcast(plan) if len(rows) <= BROADCAST_CELLS else plan

    order = Window.partitionBy("cell", "shard").orderBy(F.xxhash64(F.lit(seed + 1), F.coalesce("doc", "mark")), "doc", "size", "mark").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumns({"cell": _source_key("source"), "shard": shard})
    each = placed.withColumn("a", F.coalesce(F.sum("size").over(order), F.lit(0))).join(plan, ["cell", "shard"])

    start = lambda block: F.expr(f"if(blocks = 0, 0, ({block}) * words div blocks)")
    each = each.withColumns({"lo1": start("first"), "hi1": start("least(last, blocks)"), "hi2": start("greatest(last - blocks, 0)")})
    within = lambda x: F.least(F.greatest(F.col(x) - F.col("a"), F.lit(0)), F.col("size"))
    each = each.withColumns({"cut1_from": within("lo1"), "cut1_to": within("hi1"), "cut2_from": F.lit(0).cast("long"), "cut2_to": within("hi2")})
    taken = F.col("passes") * F.col("size") + F.col("cut1_to") - F.col("cut1_from") + F.col("cut2_to")
    return each.withColumn("taken", taken).drop("cell", "shard", "words", "blocks", "first", "last", "lo1", "hi1", "hi2", "a", "mark")


def mix_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **options) -> DataFrame:
    """One row per input row: doc, source, size, source_size, target, taken and the ranges taken."""
    from loomlog.llm.common import durable

    prepare(docs.sparkSession)
    rows = pick(docs, doc=f"{id_col} long", source=f"{source_col} string", text=f"{text_col} string")
    return mix(durable(with_sizes(rows, [])), **options)


def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``mix`` with text -> ``passes`` whole copies and one copy of the words of the run, if it has any."""
    for batch in batches:
        raw, at = utf8(batch.column("text"))
        starts, ends, rows = words_of(raw, at)
        data = raw.tobytes()
        cols = {n: batch.column(n).to_pylist() for n in ("passes", "cut1_from", "cut1_to", "cut2_from", "cut2_to")}
        index, texts = [], []
        whole = batch.column("text").to_pylist()
        for i in range(batch.num_rows):
            index += [i] * cols["passes"][i]
            texts += [whole[i]] * cols["passes"][i]
            lo = int(rows[i])
            parts = [data[starts[lo + a] : ends[lo + b - 1]].decode("utf-8") for a, b in ((cols["cut2_from"][i], cols["cut2_to"][i]), (cols["cut1_from"][i], cols["cut1_to"][i])) if b > a]
            if parts:
                index.append(i)
                texts.append("\n".join(parts))
        names = [n for n in batch.schema.names if n not in {*cols, "taken", "target", "source_size", "size", "text", "n_chars"}]
        picked = [batch.column(n).take(pa.array(index, type=pa.int64())) for n in names]
        yield pa.RecordBatch.from_arrays([*picked, pa.array(texts, type=pa.string())], names=[*names, "text"])
