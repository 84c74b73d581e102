"""Joins whose left side may hold most of its rows under one key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

JOIN_TYPES = ("inner", "left_semi", "left_anti", "left")

# Bytes of a key list that is sent to every task, as its values take up.
MAX_BROADCAST_BYTES = 64 << 20
SALTS = 64


def _width(df: DataFrame) -> Column:
    """About the bytes of a row: the length of strings and binaries, and 8 for any other column."""
    sized = [
        F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0)) if kind in ("string", "binary") else F.lit(8)
        for name, kind in df.dtypes
    ]
    return reduce(lambda a, b: a + b, sized, F.lit(8)).cast("bigint")


def is_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether ``df`` takes up at most ``max_bytes``. Every task sends one number."""
    return (df.agg(F.sum(_width(df))).first()[0] or 0) <= max_bytes


def narrow_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], spread_by: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join a wide left side with a narrow right side, without moving the left side if that can be.

    The right side is measured: a small one is broadcast, a large one goes
    through ``skew_join``.
    """
    if is_small(right):
        return left.join(F.broadcast(right), list(on), how)
    return skew_join(left, right, on, spread_by, how)


def skew_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], spread_by: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join of two large sides in which some left keys are hot.

    Spark splits a large partition of the left side as it finds it (adaptive
    skew join), for all the join types here. What it cannot do is tell apart
    rows whose key is null: they match nothing, but would meet in one task when
    the join keeps them. They are spread by a hash of ``spread_by``.
    """
    if how not in JOIN_TYPES:
        raise ValueError(f"unsupported join type: {how}")
    keys = list(on)
    if how in ("inner", "left_semi"):
        return left.join(right, keys, how)
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    spread = F.when(no_key, F.xxhash64(*spread_by)).otherwise(F.lit(0).cast("bigint"))
    salted_right = right.withColumn("_spread", F.lit(0).cast("bigint"))
    return left.withColumn("_spread", spread).join(salted_right, [*keys, "_spread"], how).drop("_spread")


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    salts: int = SALTS,
) -> DataFrame:
    """Equi-join with the rows of each left key spread over ``salts`` groups.

    The right side is repeated once per salt. ``spread_by`` names left columns
    that differ within a key; the salt is a hash of them, so a task that runs
    again sends its rows to the same place.
    """
    if how not in JOIN_TYPES:
        raise ValueError(f"unsupported join type: {how}")
    salted_left = left.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)))
    all_salts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))
    salted_right = right.withColumn("_salt", all_salts)
    return salted_left.join(salted_right, [*on, "_salt"], how).drop("_salt")
