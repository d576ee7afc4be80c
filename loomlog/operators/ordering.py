"""Positions in a global order without one task that sorts everything."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomlog.session import ensure_checkpoint_dir


def ranked(df: DataFrame, *order: Column, name: str = "position", partitions: int | None = None) -> DataFrame:
    """Adds the 1-based position in the order: ranges of the order are counted, then numbered inside.

    The dealt rows are checkpointed, so that counts and numbers speak of the same ranges. The order should be total.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *order).withColumn("__range", F.spark_partition_id()).checkpoint()
    counts = {r["__range"]: r["n"] for r in dealt.groupBy("__range").agg(F.count("*").alias("n")).collect()}
    before, total = [], 0
    for k in range(max(counts, default=-1) + 1):
        before.append(total)
        total += counts.get(k, 0)
    base = F.get(F.array(*[F.lit(b).cast("long") for b in before]), F.col("__range")) if before else F.lit(0).cast("long")
    own = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    return dealt.withColumn(name, (base + own).cast("long")).drop("__range")
