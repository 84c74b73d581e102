"""Full incremental runs."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from shelfmark.operators.backlog import backlog
from shelfmark.operators.embedding import Embedder
from shelfmark.operators.packages import cut_packages
from shelfmark.plans.collection import Collection
from shelfmark.plans.embed import EmbedRun, embed_backlog
from shelfmark.plans.refresh import refresh_files, refresh_items
from shelfmark.plans.state import Published, StateStore
from shelfmark.session import Steps
from shelfmark.sources.packages import read_entries, read_package


@dataclass(frozen=True)
class RunResult:
    """The published state and the embedding run; call ``embedded.release()`` after looking at its tables."""

    published: Published
    embedded: EmbedRun


def incremental_run(
    store: StateStore,
    collection: Collection,
    source_items: DataFrame,
    objects: DataFrame,
    contents: DataFrame | Callable[[str], bytes],
    embedder: Embedder,
    *,
    item_cap: int | None = None,
    per_run: int | None = None,
    max_pages: int | None = 100,
    now: datetime | None = None,
    **options: object,
) -> RunResult:
    """Refresh both indexes, embed new files, publish the state.

    ``per_run`` bounds how many files one run takes on, in key order.
    """
    store.init()
    baseline = store.counts()
    tables = store.read()
    # Staged: the backlog and the publication both read the refreshed tables.
    steps = Steps()
    stage = steps.stage
    items = stage(refresh_items(tables["software_index"], source_items, item_cap, now=now), "items")
    files = stage(refresh_files(tables["component_index"], objects, now), "files")
    todo = backlog(files, items, tables["embeddings_index"], "new")
    if per_run is not None:
        todo = cut_packages(todo, per_run, 1).drop("package", "position")
    todo = stage(todo, "todo")
    embedded = embed_backlog(
        todo, contents, tables["embeddings_index"], collection, embedder, max_pages=max_pages, now=now, **options
    )
    published = store.publish(
        {"software_index": items, "component_index": files, "embeddings_index": embedded.status}, baseline, now=now
    )
    steps.release()
    return RunResult(published, embedded)


def run_package(
    spark: SparkSession,
    store: StateStore,
    collection: Collection,
    plan_root: str,
    name: str,
    contents: DataFrame | Callable[[str], bytes],
    embedder: Embedder,
    *,
    now: datetime | None = None,
    **options: object,
) -> RunResult:
    """Embed the files of one package and publish their status.

    The rows of a package are reserved (``planned``), so only a finished
    status keeps a file from being embedded.
    """
    body = read_package(spark, plan_root, name)
    if body is None:
        raise FileNotFoundError(f"no package {name} below {plan_root}")
    todo, _ = read_entries(body)
    store.init()
    baseline, tables = store.counts(), store.read()
    options.setdefault("skip_statuses", ("ok",))
    embedded = embed_backlog(todo, contents, tables["embeddings_index"], collection, embedder, now=now, **options)
    published = store.publish({**tables, "embeddings_index": embedded.status}, baseline, now=now)
    return RunResult(published, embedded)
