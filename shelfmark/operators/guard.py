"""Page statistics and the page limit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.joins import narrow_join
from shelfmark.schemas import DOC_KEYS, STATUS_TOO_LARGE


def page_stats(pages: DataFrame, doc: Sequence[str] = DOC_KEYS) -> DataFrame:
    """Pages and characters per document."""
    return pages.groupBy(*doc).agg(
        F.count("*").alias("n_pages"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n_chars")
    )


def oversized(pages: DataFrame, max_pages: int | None, doc: Sequence[str] = DOC_KEYS) -> DataFrame:
    """Documents above the page limit with their failure status. No limit, no rows."""
    counted = pages.groupBy(*doc).agg(F.count("*").alias("n_pages"))
    over = F.lit(False) if max_pages is None else F.col("n_pages") > max_pages
    return counted.filter(over).withColumn("status", F.format_string(STATUS_TOO_LARGE, F.col("n_pages")))


def within_limit(
    pages: DataFrame, too_large: DataFrame, doc: Sequence[str] = DOC_KEYS, order: str = "page"
) -> DataFrame:
    """Pages of the other documents.

    Usually few documents are too large, and the pages stay where they are;
    else the pages of a huge document are spread before they are dropped.
    """
    return narrow_join(pages, too_large.select(*doc), doc, [order], "left_anti")
