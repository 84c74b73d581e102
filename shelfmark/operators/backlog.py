"""Which files still need work."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.joins import narrow_join
from shelfmark.schemas import DOC_KEYS, STATUS_OK, STATUS_PLANNED


def is_pending(status: Column) -> Column:
    """No status, or one that is neither ok nor planned."""
    return status.isNull() | ~status.isin(STATUS_OK, STATUS_PLANNED)


def status_kind(status: Column) -> Column:
    """The part before the detail: ``failed - X`` is ``failed``."""
    return F.split(status, " - ")[0]


def known_items(files: DataFrame, items: DataFrame) -> DataFrame:
    """Files whose item is in the item list. One item may own most files."""
    return narrow_join(files, items.select("qid"), ["qid"], ["component"], "left_semi")


def item_overlap(files: DataFrame, items: DataFrame) -> DataFrame:
    """Items that own at least one file: ``qid``, once each."""
    return files.select("qid").distinct().join(items.select("qid"), "qid", "left_semi")


def without_status(files: DataFrame, status: DataFrame, skip: Sequence[str] | None = None) -> DataFrame:
    """Files with no status row at all, or none of the given statuses."""
    seen = status if skip is None else status.filter(F.col("status").isin(*skip))
    return files.join(seen.select(*DOC_KEYS), list(DOC_KEYS), "left_anti")


def backlog(
    files: DataFrame,
    items: DataFrame,
    status: DataFrame,
    mode: str = "new",
    *,
    planned_ttl: timedelta | None = None,
    now: datetime | Column | None = None,
    ordered: bool = False,
) -> DataFrame:
    """``(qid, component)`` rows to work on.

    ``new``: files never tried. ``retry``: also those whose last try failed.
    With ``planned_ttl``, a reservation older than that counts as pending.
    """
    if mode == "new":
        done = status
        if planned_ttl is not None:
            done = status.filter(~_expired(planned_ttl, now))
    elif mode == "retry":
        done = status.filter(~is_pending(F.col("status")))
        if planned_ttl is not None:
            done = done.filter(~_expired(planned_ttl, now))
    else:
        raise ValueError(f"unknown mode: {mode}")
    # The anti join goes first: its keys are unique, and it removes most files
    # before the join on the item, which can be skewed.
    todo = files.select(*DOC_KEYS).join(done.select(*DOC_KEYS), list(DOC_KEYS), "left_anti")
    pending = known_items(todo, items)
    return pending.orderBy(*DOC_KEYS) if ordered else pending


def _expired(ttl: timedelta, now: datetime | Column | None) -> Column:
    moment = F.current_timestamp() if now is None else F.lit(now) if isinstance(now, datetime) else now
    old = F.col("updated_at") < moment - F.expr(f"interval {int(ttl.total_seconds())} seconds")
    return F.coalesce((F.col("status") == STATUS_PLANNED) & old, F.lit(False))
