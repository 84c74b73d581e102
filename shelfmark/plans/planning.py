"""Cutting the backlog into package files and reserving it."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.backlog import backlog
from shelfmark.operators.packages import (
    cut_packages,
    package_documents,
    reservations,
    write_packages,
)
from shelfmark.operators.upsert import upsert
from shelfmark.plans.state import Published, StateStore
from shelfmark.schemas import DOC_KEYS
from shelfmark.session import stage


def plan_packages(
    store: StateStore, root: str, size: int = 10, packages: int | None = None, now: datetime | None = None
) -> tuple[DataFrame, Published | None]:
    """Write package files for pending work and publish the reservations.

    Without ``packages`` the whole backlog is cut.

    Returns the packaged rows and the published state; without pending work
    nothing is written. The checksum in the files is that of the state before
    the reservations.
    """
    if not store.exists():
        raise FileNotFoundError(f"no state snapshot below {store.root}")
    moment = now or datetime.now(timezone.utc)
    checksum = store.checksum()
    tables = store.read()
    pending = backlog(tables["component_index"], tables["software_index"], tables["embeddings_index"], "retry")
    packaged = stage(cut_packages(pending, size, packages), "packages")
    if packaged.isEmpty():
        return packaged, None
    status = upsert(tables["embeddings_index"], reservations(packaged, moment), DOC_KEYS)
    published = store.publish({**tables, "embeddings_index": status}, store.counts(), now=moment)
    write_packages(package_documents(packaged, F.lit(checksum), F.lit(moment.isoformat())), root)
    return packaged, published
