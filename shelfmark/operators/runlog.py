"""Run summaries, throughput and remaining time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions import keys
from shelfmark.operators.backlog import status_kind


def run_summary(status: DataFrame) -> DataFrame:
    """Rows written per kind of status: ``status_kind, n``."""
    return status.groupBy(status_kind(F.col("status")).alias("status_kind")).agg(F.count("*").alias("n"))


def remaining_time(completed: Column, remaining: Column, elapsed_seconds: Column) -> Column:
    """Seconds left at the throughput so far; null before anything is done."""
    usable = (completed > 0) & (elapsed_seconds > 0)
    return F.when(usable, remaining / (completed / elapsed_seconds))


def progress(
    log: DataFrame, run: Sequence[str], ts: str, total: Column, step: str = "1 hour"
) -> DataFrame:
    """Progress of each run at the end of every time step.

    ``log`` has one row per finished document; ``total`` is an aggregate giving
    the documents of the run. Rows are first counted per step, so the running
    count goes over steps, not documents. Elapsed time is measured from the
    start of the run's first step.
    """
    start = F.window(ts, step)
    steps = log.groupBy(*run, start.alias("w")).agg(F.count("*").alias("n"))
    totals = log.groupBy(*run).agg(total.alias("total"))
    so_far = Window.partitionBy(*run).orderBy("w.end").rowsBetween(Window.unboundedPreceding, 0)
    counted = steps.select(
        *run,
        F.col("w.end").alias("step_end"),
        F.sum("n").over(so_far).alias("completed"),
        F.min("w.start").over(so_far).alias("_begin"),
    ).join(totals, list(run))
    elapsed = F.unix_micros("step_end") / 1e6 - F.unix_micros("_begin") / 1e6
    remaining = F.col("total") - F.col("completed")
    return counted.select(
        *run,
        "step_end",
        "completed",
        remaining.alias("remaining"),
        (F.col("completed") / elapsed).alias("per_second"),
        keys.duration(remaining_time(F.col("completed"), remaining, elapsed)).alias("eta"),
    )
