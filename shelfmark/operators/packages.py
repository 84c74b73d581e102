"""Cutting an ordered backlog into packages of fixed size."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions import keys
from shelfmark.operators.items import IN_TASK_ROWS
from shelfmark.operators.ordinals import with_ordinal
from shelfmark.schemas import CRAN_PACKAGE, DOC_KEYS, STATUS_PLANNED

# Fixed value: version field of package files.
PLANNER_VERSION = "1.0"


def cut_packages(
    backlog: DataFrame, size: int, packages: int | None = None, order: Sequence[str] = DOC_KEYS
) -> DataFrame:
    """Backlog rows with ``package`` (from 0) and ``position`` inside it (from 0).

    With ``packages`` only that many are cut. Few rows are a top-k numbered in
    one task; without a count, or with a large one, rows are numbered by a
    distributed sort.
    """
    if size <= 0 or (packages is not None and packages <= 0):
        raise ValueError("size and packages must be positive")
    wanted = None if packages is None else size * packages
    if wanted is not None and wanted <= IN_TASK_ROWS:
        first = backlog.orderBy(*order).limit(wanted)
        numbered = first.withColumn("_n", F.row_number().over(Window.orderBy(*order)) - 1)
    else:
        numbered = with_ordinal(backlog, order, "_n")
        if wanted is not None:
            numbered = numbered.filter(F.col("_n") < wanted)
    return (
        numbered.withColumn("package", F.floor(F.col("_n") / size).cast("int"))
        .withColumn("position", (F.col("_n") % size).cast("int"))
        .drop("_n")
    )


def package_documents(
    packaged: DataFrame, checksum: Column, created_at: Column, document_type: Column | None = None
) -> DataFrame:
    """One row per package with the fields of a package file.

    A row holds a whole package, as its reader does: it is as large as the size that cut it.
    """
    kind = F.lit(CRAN_PACKAGE) if document_type is None else document_type
    entry = F.struct("position", "qid", "component", kind.alias("document_type"))
    grouped = packaged.groupBy("package").agg(F.sort_array(F.collect_list(entry)).alias("_entries"))
    entries = F.transform(
        "_entries",
        lambda e: F.struct(
            e["qid"].alias("qid"), e["component"].alias("component"), e["document_type"].alias("document_type")
        ),
    )
    return grouped.select(
        "package",
        F.lit(PLANNER_VERSION).alias("planner_version"),
        created_at.alias("created_at"),
        checksum.alias("state_db_checksum"),
        keys.package_id(F.col("package")).alias("package_id"),
        entries.alias("entries"),
    )


def package_json(documents: DataFrame) -> DataFrame:
    """Package files as text: ``package_id, body``."""
    fields = ("planner_version", "created_at", "state_db_checksum", "package_id", "entries")
    return documents.select("package_id", F.to_json(F.struct(*fields)).alias("body"))


def write_packages(documents: DataFrame, root: str) -> None:
    """One JSON document per package, below ``<root>/planned/package_id=…``.

    Packages already there under other names stay.
    """
    target = "/".join(p for p in (root.rstrip("/"), "planned") if p)
    bodies = package_json(documents).select(F.col("package_id"), F.col("body").alias("value"))
    writer = bodies.repartition("package_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("package_id").text(target)


def reservations(packaged: DataFrame, planned_at: datetime | Column) -> DataFrame:
    """Status rows that reserve the packaged files."""
    moment = F.lit(planned_at) if isinstance(planned_at, datetime) else planned_at
    return packaged.select(
        *DOC_KEYS, moment.cast("timestamp").alias("updated_at"), F.lit(STATUS_PLANNED).alias("status")
    )
