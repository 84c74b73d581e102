"""Running positions without sending a whole group, or everything, to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.session import stage

# Rows of a group that one window sees at a time, in units of the order column.
BLOCK = 4096

_BEFORE = (Window.unboundedPreceding, -1)


def running_offset(
    df: DataFrame, group: Sequence[str], order: str, value: Column, out: str, block: int = BLOCK
) -> DataFrame:
    """Exclusive running sum of ``value`` within ``group``, ordered by an integral column.

    Two levels: rows are windowed per block of ``block`` order values, and the
    blocks' totals (one small row each) are summed separately. A group holding
    a large share of all rows is therefore spread over its blocks.
    ``(group, order)`` must be unique.
    """
    sized = df.withColumn("_value", value.cast("bigint")).withColumn(
        "_block", F.floor(F.coalesce(F.col(order), F.lit(0)) / block)
    )
    totals = sized.groupBy(*group, "_block").agg(F.sum("_value").alias("_total"))
    blocks = Window.partitionBy(*group).orderBy("_block").rowsBetween(*_BEFORE)
    starts = totals.select(
        *group, "_block", F.coalesce(F.sum("_total").over(blocks), F.lit(0)).alias("_start")
    )
    rows = Window.partitionBy(*group, "_block").orderBy(order).rowsBetween(*_BEFORE)
    inside = sized.withColumn("_inside", F.coalesce(F.sum("_value").over(rows), F.lit(0)))
    return (
        inside.join(starts, [*group, "_block"])
        .withColumn(out, F.col("_start") + F.col("_inside"))
        .drop("_value", "_block", "_start", "_inside")
    )


def with_ordinal(df: DataFrame, order: Sequence[str], out: str = "ordinal") -> DataFrame:
    """Position of every row in the total order of ``order``, from 0.

    A range-partitioned sort numbers rows inside each partition; the partition
    sizes (one row per partition) turn that into a global position. The sorted
    rows are written out first: range bounds come from a sample, and numbers
    taken from two different evaluations would not fit together.
    ``order`` must be unique.
    """
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        df.repartitionByRange(partitions, *order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    staged = stage(ranged, "ordinal")
    # monotonically_increasing_id: partition number in the upper bits, row number in the lower 33.
    numbered = staged.withColumn("_part", F.shiftright("_at", 33)).withColumn(
        "_row", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    )
    sizes = numbered.groupBy("_part").agg(F.count("*").alias("_size"))
    starts = sizes.select(
        "_part",
        F.coalesce(F.sum("_size").over(Window.orderBy("_part").rowsBetween(*_BEFORE)), F.lit(0)).alias("_start"),
    )
    # At most one row per shuffle partition: safe to broadcast whatever the data size.
    return (
        numbered.join(F.broadcast(starts), "_part")
        .withColumn(out, F.col("_start") + F.col("_row"))
        .drop("_part", "_row", "_start", "_at")
    )
