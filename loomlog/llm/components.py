"""Connected components: alternating large-star and small-star steps as aggregations and joins.

Up to SMALL_EDGES edges (16 bytes each, counted first) one task runs a union-find instead; the result is the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomlog.llm.common import discard, settled, tidy, written

SMALL_EDGES = 500_000
#: Parts of a node's neighbours.
SALTS = 32


def _find(root: dict[int, int], x: int) -> int:
    top = x
    while root.setdefault(top, top) != top:
        top = root[top]
    while root[x] != top:
        root[x], x = top, root[x]
    return top


def united(root: dict[int, int], a: int, b: int) -> bool:
    """Unites the sets of a and b in a union-find; whether they were apart."""
    a, b = _find(root, a), _find(root, b)
    root[max(a, b)] = min(a, b)
    return a != b


def _union_find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    root: dict[int, int] = {}
    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            united(root, u, v)
    nodes = np.array(sorted(root), dtype=np.int64)
    roots = np.array([_find(root, x) for x in nodes.tolist()], dtype=np.int64)
    for a in range(0, len(nodes), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(nodes[a : a + (1 << 16)]), pa.array(roots[a : a + (1 << 16)])], names=["node", "root"])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: u, v. Every neighbour that is larger (large star) or not larger (small star) joins the smallest one."""
    around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    # The centre of a large star is dealt out by its neighbours, in the counts and in the join.
    around = around.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)))
    parts = around.groupBy("u", "salt").agg(F.min("v").alias("v"))
    least = parts.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.collect_set("salt").alias("salts"))
    joined = around.join(least.select("u", "m", F.explode("salts").alias("salt")), ["u", "salt"])
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges: u, v (long) -> node, root, for every node that has an edge; root is the smallest node it reaches."""
    now, n = settled(edges.select("u", "v").where("u != v"))
    if n <= SMALL_EDGES:
        return now.coalesce(1).mapInArrow(tidy(_union_find), "node long, root long")
    now, path = written(now.distinct())
    while True:
        after, next_path = written(_star(_star(now, True), False))
        # A forest of stars whose centres are the smallest nodes is a fixed point.
        same = now.count() == after.count() and after.exceptAll(now).isEmpty()
        discard(edges.sparkSession, path)
        now, path = after, next_path
        if same:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
