"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.session import Steps


def _signature(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v")
    row = edges.agg(F.count("*"), F.bit_xor(mixed), F.sum(F.pmod(mixed, F.lit(1 << 31)))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    # A hub's rows are joined with one row; Spark splits such a partition.
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, steps: Steps) -> DataFrame:
    """(node, root) for every node with a link; the root is the smallest node that can be reached.

    ``edges`` has columns ``u`` and ``v``, orderable and not null. Rounds go on
    until nothing changes; each is written to the shared folder, so the lineage
    stays short.
    """
    current = steps.stage(edges.filter("u <> v").select("u", "v").distinct(), "edges")
    known = _signature(current)
    while True:
        current = steps.stage(_small_star(_large_star(current).distinct()).distinct().filter("u <> v"), "edges")
        now = _signature(current)
        if now == known:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
        known = now
