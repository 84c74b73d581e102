"""Array columns -> rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unnest(df: DataFrame, array: Column, value: str, pos: str | None = None) -> DataFrame:
    """``df`` with one row per array element; null and empty arrays give no rows.

    A plain ``explode`` makes the optimizer infer ``size(array) > 0`` and push
    it to the scan, which computes a costly array (tokens, chunks, anything
    from a Python worker) a second time. The outer form is not rewritten, and
    the filter that follows it stays above.
    """
    at = pos or "_pos"
    rows = df.select("*", F.posexplode_outer(array).alias(at, value)).filter(F.col(at).isNotNull())
    return rows if pos else rows.drop(at)
