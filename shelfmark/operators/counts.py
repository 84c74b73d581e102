"""Row counts, deltas against a baseline, and freshness."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import keys


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table, n, position`` for each table, in the order given."""
    parts = [
        df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n", F.lit(i).alias("position"))
        for i, (name, df) in enumerate(tables.items())
    ]
    return reduce(DataFrame.unionByName, parts)


def count_deltas(current: DataFrame, baseline: DataFrame | None) -> DataFrame:
    """``current`` with ``delta``: a table without a baseline counts from 0; no baseline, no delta."""
    if baseline is None:
        return current.withColumn("delta", F.lit(None).cast("bigint"))
    before = baseline.select("table", F.col("n").alias("_before"))
    joined = current.join(before, "table", "left")
    return joined.withColumn("delta", F.col("n") - F.coalesce("_before", F.lit(0))).drop("_before")


def count_message(deltas: DataFrame, lead: str = "Updated state tables") -> DataFrame:
    """One row ``message``: ``lead [table:n (+d); …]``. One entry per state table."""
    part = keys.signed_count(F.col("table"), F.col("n"), F.col("delta"))
    listed = deltas.agg(F.sort_array(F.collect_list(F.struct("position", part.alias("part")))).alias("p"))
    summary = F.array_join(F.transform("p", lambda x: x["part"]), "; ")
    return listed.select(F.concat(F.lit(f"{lead} ["), summary, F.lit("]")).alias("message"))


def freshness(
    table: DataFrame, now: datetime | Column | None = None, max_age: timedelta = timedelta(hours=1)
) -> DataFrame:
    """One row ``updated_at, is_fresh``; an empty table is not fresh."""
    moment = F.current_timestamp() if now is None else F.lit(now) if isinstance(now, datetime) else now
    limit = moment - F.expr(f"interval {int(max_age.total_seconds())} seconds")
    return table.agg(F.max("updated_at").alias("updated_at")).withColumn(
        "is_fresh", F.coalesce(F.col("updated_at") > limit, F.lit(False))
    )
