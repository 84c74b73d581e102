"""Incremental pull of the item list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.ordinals import with_ordinal

# Rows that an ordered limit may hold in one task.
IN_TASK_ROWS = 1_000_000


def page(df: DataFrame, order: str, offset: int = 0, limit: int | None = None) -> DataFrame:
    """Ordered rows from ``offset`` on, at most ``limit`` of them.

    A small page is a top-k; a deep one is cut by global position, because the
    top-k of a deep page would pass all skipped rows through one task.
    """
    if offset < 0 or (limit is not None and limit < 0):
        raise ValueError("offset and limit must not be negative")
    if limit is None and offset == 0:
        return df.orderBy(order)
    if limit is not None and offset + limit <= IN_TASK_ROWS:
        return df.orderBy(order).offset(offset).limit(limit)
    placed = with_ordinal(df, [order], "_ordinal").filter(F.col("_ordinal") >= offset)
    if limit is not None:
        placed = placed.filter(F.col("_ordinal") < offset + limit)
    return placed.drop("_ordinal").orderBy(order)


def new_items(
    source: DataFrame, known: DataFrame, cap: int | None = None, mode: str = "anti"
) -> DataFrame:
    """Items of ``source`` still to be stored, at most the ``cap`` first of them in ``qid`` order.

    ``anti`` takes the items that are not known. ``offset`` skips as many
    ordered items as are known, which misses ids that sort before the position
    reached earlier; it is there for results that must equal such a pull.
    """
    if mode == "anti":
        fresh = source.select("qid").join(known.select("qid"), "qid", "left_anti")
        return fresh if cap is None else page(fresh, "qid", 0, cap)
    if mode == "offset":
        return page(source.select("qid"), "qid", known.count(), cap)
    raise ValueError(f"unknown mode: {mode}")
