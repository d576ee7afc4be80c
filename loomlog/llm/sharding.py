"""Balanced label propagation: linked documents move to their neighbours' shards under capacity quotas.

Documents are linked when they share a key (here: an equal text). A shard is a label. In every round a key's labels
are counted (pre-aggregated before the shuffle), each linked document prefers the label most common among its
neighbours, and the wishes are granted by a shards x shards matrix of quotas: swaps balance each other, and what is
left fills free capacity. Nothing is done pair by pair, and rounds are cut by reliable checkpoints.

Large keys are counted by anchors of about ANCHOR_ROWS documents, so that no task sees a group with a third of all rows
whole; a key's vote is the sum over its anchors, and its anchors move together. After the rounds groups get their final
shards within exact quotas (counts are at most one apart): large groups are dealt out on the driver, largest first;
small ones keep their label while it has room, the others fill what is left in ranges of a two-level running sum;
documents without a copy fill the rest. A group larger than a quota takes as few shards as possible. A smaller one is
cut only if no shard has room for it whole when its turn comes, as where hardly any document is without copies. A rank
within the shard, by another two-level count, is the slot.

Only built-in functions run on the executors; the driver gets shards x shards counts and about DEALT large groups at most.

Defined results: null text equals empty text and has size 1; repeated rows are placed one by one; null identifiers are
placed like others; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomlog.llm.common import durable, pick, prepare

#: Rounds of propagation, share that a shard may exceed its even size by meanwhile.
ROUNDS, SLACK = 4, 0.02
#: Documents of an anchor on average where a key has more; parts that a key's rows are counted in.
ANCHOR_ROWS, SALTS = 512, 64
#: Rows of a bucket of ranks on average, and the most buckets of a label.
BUCKET_ROWS, MAX_BUCKETS = 512, 4096
#: Groups that hold at least one in so many rows are given their shards on the driver: at most as many groups.
DEALT = 1 << 14


def anchors(rows: DataFrame) -> DataFrame:
    """Adds anchor; key and anchor are null where the key has one row. rows: key, node. A key's rows meet only as salted counts."""
    salt = F.pmod("node", F.lit(SALTS))
    counts = rows.groupBy("key", salt.alias("salt")).agg(F.count("*").alias("c"))
    totals = counts.groupBy("key").agg(F.sum("c").alias("n"), F.collect_set("salt").alias("salts")).where("n > 1")
    back = totals.select("key", "n", F.explode("salts").alias("salt"))
    anchor = F.expr(f"xxhash64(key, pmod(shiftright(node, 8), cast(ceil(n / {ANCHOR_ROWS}) as bigint)))")
    many = F.col("n").isNotNull()
    return rows.withColumn("salt", salt).join(back, ["key", "salt"], "left").withColumn("anchor", F.when(many, anchor)).withColumn("key", F.when(many, F.col("key"))).drop("salt", "n")


def quota(wishes: np.ndarray, loads: np.ndarray, capacity: float) -> np.ndarray:
    """Share of the wishes from a to b that is granted: swaps in pairs, then free capacity in proportion."""
    wishes = wishes.astype(float)
    grant = np.minimum(wishes, wishes.T)
    rest = wishes - grant
    free = np.maximum(0.0, capacity - loads)
    asked = rest.sum(axis=0)
    grant += rest * np.minimum(1.0, np.divide(free, asked, out=np.zeros_like(free), where=asked > 0))
    return np.divide(grant, wishes, out=np.zeros_like(grant), where=wishes > 0)


def _cell(matrix: np.ndarray, row: Column, column: Column) -> Column:
    flat = F.array(*[F.lit(float(x)) for x in matrix.ravel()])
    return F.get(flat, (row * F.lit(matrix.shape[1]) + column).cast("int"))


def propagate(nodes: DataFrame, shards: int, rounds: int = ROUNDS) -> DataFrame:
    """nodes: node, key (neighbourhood or null), anchor, label -> the same with the last labels, one for each key."""
    total = nodes.count()
    linked = nodes.where("anchor is not null")
    alone = nodes.where("anchor is null")
    parts = durable(linked.select("key", "anchor").distinct())
    fixed = np.zeros(shards)
    for label, n in alone.groupBy("label").count().collect():
        fixed[label] = n
    for k in range(rounds):
        # Counts by anchor are summed for the key; the key's answer goes back to each of its anchors.
        votes = linked.groupBy("key", "anchor", "label").agg(F.count("*").alias("c")).groupBy("key", "label").agg(F.sum("c").alias("c"))
        best = votes.groupBy("key").agg(F.max_by("label", F.struct("c", F.xxhash64("key", "label"))).alias("best"))
        wish = durable(linked.join(parts.join(best, "key"), ["key", "anchor"]))
        wishes, loads = np.zeros((shards, shards)), fixed.copy()
        for a, b, n in wish.groupBy("label", "best").count().collect():
            loads[a] += n
            if a != b:
                wishes[a, b] = n
        if not wishes.any():
            linked = wish.drop("best")
            break
        # Quotas keep the sizes even from round to round; in the last one the stragglers follow their neighbours,
        # and settle() moves what this adds to a shard beyond its quota.
        share = quota(wishes, loads, (1 + SLACK) * total / shards) if k < rounds - 1 else np.ones((shards, shards))
        # Neighbours draw the same lot, so that they move together.
        lot = F.pmod(F.xxhash64("key", F.lit(k)), F.lit(1 << 20)) / F.lit(float(1 << 20))
        linked = wish.withColumn("label", F.when(lot < _cell(share, F.col("label"), F.col("best")), F.col("best")).otherwise(F.col("label"))).drop("best")
    return linked.unionByName(alone)


def positions(rows: DataFrame, lane: str, weight: str, ties: list[str], wanted: int) -> DataFrame:
    """Adds start: the weight before the row in its lane, in the order (place, ties). Sums of buckets, then inside them."""
    rows = rows.withColumn("bucket", F.pmod(F.shiftright("place", 20), F.lit(wanted)))
    prior = Window.partitionBy(lane).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    own = Window.partitionBy(lane, "bucket").orderBy("place", *ties).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(lane, "bucket").agg(F.sum(weight).alias("c"))
    offsets = sums.select(lane, "bucket", F.coalesce(F.sum("c").over(prior), F.lit(0)).alias("offset"))
    inner = rows.withColumn("inner", F.coalesce(F.sum(weight).over(own), F.lit(0)))
    return inner.join(offsets, [lane, "bucket"]).withColumn("start", F.col("offset") + F.col("inner")).drop("bucket", "offset", "inner")


def deal(groups: list[tuple[int, int, int]], room: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Parts (key, first row, one past the last, shard) of groups (key, rows, label), largest first; room is used up.

    A group stays whole in its label, else in the fullest shard that has room; one that fits nowhere takes the emptiest
    shards in turn, which is the least number of parts.
    """
    parts = []
    for key, n, label in sorted(groups, key=lambda g: (-g[1], g[0])):
        at = 0
        while at < n:
            fits = np.flatnonzero(room >= n - at)
            if len(fits):
                shard = label if room[label] >= n - at else int(fits[room[fits].argmin()])
            else:
                shard = int(room.argmax())
            end = at + int(min(n - at, room[shard]))
            parts.append((key, at, end, shard))
            room[shard] -= end - at
            at = end
    return parts


def _range(room: np.ndarray) -> tuple[Column, Column]:
    """The shard whose room, laid end to end, holds start, and the end of that room."""
    ends = F.array(*[F.lit(int(x)) for x in np.cumsum(room)]).cast("array<long>")
    shard = F.size(F.filter(ends, lambda e: e <= F.col("start")))
    return shard, F.get(ends, shard)


def _loads(rows: DataFrame, column: str, weight: str, shards: int) -> np.ndarray:
    out = np.zeros(shards, dtype=np.int64)
    for shard, n in rows.groupBy(column).agg(F.sum(weight)).collect():
        out[shard] = n
    return out


def settle(nodes: DataFrame, shards: int) -> DataFrame:
    """nodes: node, doc, key, anchor, label (one for each key) -> the same with labels that fill all quotas exactly."""
    spark, total = nodes.sparkSession, nodes.count()
    ends = [-(-s * total // shards) for s in range(shards + 1)]
    room = np.diff(np.array(ends, dtype=np.int64))
    wanted = max(1, min(MAX_BUCKETS * shards, total // BUCKET_ROWS))
    linked, alone = nodes.where("anchor is not null"), nodes.where("anchor is null")
    parts = durable(linked.groupBy("key", "anchor").agg(F.count("*").alias("c"), F.max("label").alias("label")))
    keys = durable(parts.groupBy("key").agg(F.sum("c").alias("n"), F.max("label").alias("label")).withColumn("place", F.xxhash64("key")))
    large = F.col("n") * F.lit(max(DEALT, 4 * shards)) >= F.lit(total)
    dealt = deal([(r["key"], r["n"], r["label"]) for r in keys.where(large).collect()], room)

    # Small groups: first those that fit their label, then ranges of the room that is left.
    small = durable(positions(keys.where(~large), "label", "n", ["key"], wanted))
    fits = F.col("start") + F.col("n") <= F.get(F.array(*[F.lit(int(x)) for x in room]).cast("array<long>"), F.col("label"))
    stay = small.where(fits)
    room -= _loads(stay, "label", "n", shards)
    pool = durable(positions(small.where(~fits).drop("start", "label").withColumn("lane", F.lit(0)), "lane", "n", ["key"], wanted))
    shard, end = _range(room)
    pool = pool.withColumn("shard", shard).withColumn("whole", F.col("start") + F.col("n") <= end)
    room -= _loads(pool.where("whole"), "shard", "n", shards)
    # At most one group lies across each border.
    dealt += deal([(r["key"], r["n"], r["shard"]) for r in pool.where("not whole").collect()], room)

    times: dict[int, int] = {}
    for key, *_ in dealt:
        times[key] = times.get(key, 0) + 1
    pieces = lambda once: spark.createDataFrame([p for p in dealt if (times[p[0]] == 1) == once], "key long, first long, last long, shard int")
    homes = stay.select("key", F.col("label").alias("shard")).unionByName(pool.where("whole").select("key", "shard")).unionByName(pieces(True).select("key", "shard"))
    out = linked.drop("label").join(parts.select("key", "anchor").join(homes, "key"), ["key", "anchor"]).withColumnRenamed("shard", "label")

    if max(times.values(), default=1) > 1:
        cut = F.broadcast(pieces(False))
        names = F.broadcast(spark.createDataFrame([(k,) for k, n in times.items() if n > 1], "key long"))
        prior = Window.partitionBy("key").orderBy("anchor").rowsBetween(Window.unboundedPreceding, -1)
        offsets = parts.join(names, "key").select("key", "anchor", F.coalesce(F.sum("c").over(prior), F.lit(0)).alias("offset"))
        own = Window.partitionBy("key", "anchor").orderBy("node", "doc")
        rows = linked.drop("label").join(names, "key").withColumn("rn", F.row_number().over(own)).join(offsets, ["key", "anchor"])
        rows = rows.withColumn("at", F.col("offset") + F.col("rn") - 1).join(cut, "key").where("at >= first and at < last")
        out = out.unionByName(rows.withColumnRenamed("shard", "label").drop("rn", "offset", "at", "first", "last"))

    shard, _ = _range(room)
    rest = alone.drop("label").withColumn("place", F.xxhash64("node")).withColumn("lane", F.lit(0)).withColumn("one", F.lit(1))
    rest = positions(rest, "lane", "one", ["node", "doc"], wanted).withColumn("label", shard).drop("place", "lane", "one", "start")
    return out.unionByName(rest)


def ranked(rows: DataFrame, shards: int) -> DataFrame:
    """Adds shard and slot to rows with label, anchor, node and doc; counts are at most one apart."""
    n = rows.count()
    wanted = max(1, min(MAX_BUCKETS, n // (shards * BUCKET_ROWS)))
    rows = rows.withColumn("place", F.xxhash64(F.coalesce("anchor", "node"))).withColumn("bucket", F.pmod(F.shiftright("place", 20), F.lit(wanted)))
    counts = rows.groupBy("label", "bucket").agg(F.count("*").alias("c"))
    before = {r["label"]: r["c"] for r in counts.groupBy("label").agg(F.sum("c").alias("c")).collect()}
    first = F.array(*[F.lit(sum(before.get(a, 0) for a in range(b))).cast("long") for b in range(shards)])
    prior = Window.partitionBy("label").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("label", "bucket", (F.get(first, F.col("label").cast("int")) + F.coalesce(F.sum("c").over(prior), F.lit(0))).alias("offset"))
    own = Window.partitionBy("label", "bucket").orderBy("place", "node", "doc")
    rank = rows.withColumn("rn", F.row_number().over(own)).join(offsets, ["label", "bucket"]).withColumn("rank", F.col("offset") + F.col("rn") - 1)
    placed = rank.withColumn("shard", F.expr(f"cast(rank * {shards} div {max(n, 1)} as int)"))
    return placed.withColumn("slot", F.expr(f"rank - (shard * {n}L + {shards - 1}) div {shards}")).drop("place", "bucket", "offset", "rn", "rank", "label")


def balanced_shards(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc, size (UTF-8 bytes + 1), text_crc32, shard and slot. Linked: equal texts."""
    prepare(docs.sparkSession)
    rows = pick(docs, doc=f"{id_col} long", text=f"{text_col} string").withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.select("doc", (F.octet_length("text") + 1).cast("long").alias("size"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"), F.xxhash64("text").alias("key"))
    rows = durable(rows.withColumn("node", F.xxhash64("doc", "key")))
    nodes = anchors(rows).withColumn("label", F.pmod(F.xxhash64("node", F.lit(5)), F.lit(shards)).cast("int"))
    return ranked(durable(settle(durable(propagate(durable(nodes), shards)), shards)), shards).select("doc", "size", "text_crc32", "shard", "slot", "anchor")
