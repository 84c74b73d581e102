"""Refreshing the item list and the file index."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.counts import freshness
from shelfmark.operators.items import new_items
from shelfmark.operators.upsert import upsert
from shelfmark.schemas import DOC_KEYS
from shelfmark.sources.objects import index_files, indexed


def refresh_items(
    state_items: DataFrame, source: DataFrame, cap: int | None = None, mode: str = "anti", now: datetime | None = None
) -> DataFrame:
    """The item list with up to ``cap`` new items of ``source`` put in."""
    moment = F.lit(now or datetime.now(timezone.utc))
    fresh = new_items(source, state_items, cap, mode).select("qid", moment.alias("updated_at"))
    return upsert(state_items, fresh, ["qid"])


def refresh_files(
    state_files: DataFrame,
    objects: DataFrame,
    now: datetime | None = None,
    max_age: timedelta = timedelta(hours=1),
    distinct: bool = True,
) -> DataFrame:
    """The file index with all listed files put in; unchanged while it is younger than ``max_age``."""
    moment = now or datetime.now(timezone.utc)
    if freshness(state_files, moment, max_age).collect()[0].is_fresh:
        return state_files
    listed = indexed(index_files(objects, distinct=distinct)).withColumn("updated_at", F.lit(moment))
    return upsert(state_files, listed, DOC_KEYS)
