"""Embedding a backlog of files."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.backlog import without_status
from shelfmark.operators.chunking import number_chunks, semantic_pieces, split_oversize
from shelfmark.operators.embedding import Embedder
from shelfmark.operators.guard import oversized, within_limit
from shelfmark.operators.joins import narrow_join
from shelfmark.operators.points import SOURCE, add_metadata, to_points
from shelfmark.operators.runlog import run_summary
from shelfmark.operators.upsert import upsert
from shelfmark.plans.collection import Collection
from shelfmark.plans.textvectors import TextVectors
from shelfmark.schemas import CRAN_PACKAGE, DOC_KEYS, STATUS_OK, STATUS_TIMEOUT, ChunkParams
from shelfmark.session import Steps
from shelfmark.sources.objects import fetch_contents, select_contents
from shelfmark.sources.pages import Extractor, load_pages, split_errors


@dataclass(frozen=True)
class EmbedRun:
    """What one run did: new status table, quarantined files, rows per kind, points added.

    The DataFrames read staged steps; ``release`` deletes those once the
    results have been stored.
    """

    status: DataFrame
    results: DataFrame
    quarantine: DataFrame
    summary: DataFrame
    points_added: int
    steps: Steps

    def release(self) -> None:
        self.steps.release()


def embed_backlog(
    todo: DataFrame,
    contents: DataFrame | Callable[[str], bytes],
    status: DataFrame,
    collection: Collection,
    embedder: Embedder,
    *,
    params: ChunkParams = ChunkParams(),
    extractors: Mapping[str, Extractor] | None = None,
    document_type: str = CRAN_PACKAGE,
    source: str = SOURCE,
    max_pages: int | None = 75,
    timeout_seconds: float | None = None,
    id_cols: Sequence[str] = ("qid",),
    prefix_rules: Mapping[str, tuple[str, str]] | None = None,
    skip_statuses: Sequence[str] | None = None,
    replace_document: bool = False,
    known: TextVectors | None = None,
    now: datetime | None = None,
) -> EmbedRun:
    """Embed the ``(qid, component)`` rows of ``todo``.

    ``contents`` is a ``(key, content)`` table, or a function that reads one
    object by key inside the tasks, so that nothing but the wanted files is read.
    Files with a status row (or one of ``skip_statuses``) are left out. A file
    over the page or time limit gets a failure status. One that cannot be
    read, split or embedded goes to quarantine without a status, and one
    without any text gets no status either: both are tried again by the next
    run. With ``known``, texts of chunks that it holds are not embedded again.

    Pages and their pieces are written to the work folder once each, since
    several later steps read them, and points to the collection alone; points
    are stored before the status, and their ids are deterministic, so a run
    that broke off can simply be started again.
    """
    moment = now or datetime.now(timezone.utc)
    steps = Steps()
    stage = steps.stage
    wanted = stage(without_status(todo.select(*DOC_KEYS).distinct(), status, skip_statuses), "wanted")
    if isinstance(contents, DataFrame):
        files = select_contents(contents, wanted)
    else:
        files = fetch_contents(wanted, contents)
    pages = stage(load_pages(files, extractors), "pages")
    good, unreadable = split_errors(pages)

    too_large = stage(oversized(good, max_pages), "oversized")
    kept = good if max_pages is None else within_limit(good, too_large)
    split = semantic_pieces(add_metadata(kept, document_type, source), params, embedder, timeout_seconds, True)
    split = stage(split.withColumn("pieces", split_oversize(F.col("pieces"), params)).drop("text"), "pieces")
    unsplit = _failed(split)
    sound = _without(split, unsplit, ["page"])
    late = _timed_out(sound, timeout_seconds)
    in_time = sound if late is None else narrow_join(sound, late, DOC_KEYS, ["page"], "left_anti")
    chunks = number_chunks(in_time.drop("seconds", "timed_out", "error"), "pieces")

    before = collection.size() if collection.exists() else 0
    collection.ensure(embedder.dim)
    points = to_points(chunks, embedder, id_cols, prefix_rules, True, False, known)
    # A document gets all of its points or none.
    unembedded = collection.upsert_sound(points, id_cols if replace_document else None, moment, stage)

    chunked = in_time.filter(F.size("pieces") > 0).select(*DOC_KEYS).distinct()
    done = _without(chunked, unembedded, DOC_KEYS).withColumn("status", F.lit(STATUS_OK))
    results = done.unionByName(too_large.select(*DOC_KEYS, "status"))
    if late is not None:
        results = results.unionByName(late.withColumn("status", F.lit(STATUS_TIMEOUT)))
    results = stage(results.withColumn("updated_at", F.lit(moment)), "results")
    return EmbedRun(
        status=upsert(status, results, DOC_KEYS),
        results=results,
        quarantine=unreadable.unionByName(unsplit).unionByName(unembedded),
        summary=run_summary(results),
        points_added=collection.size() - before,
        steps=steps,
    )


def _failed(rows: DataFrame) -> DataFrame:
    """Documents with a failed row, and one of their errors."""
    failed = rows.filter(F.col("error").isNotNull())
    return failed.groupBy(*DOC_KEYS).agg(F.min("error").alias("error"))


def _without(rows: DataFrame, failed: DataFrame, spread_by: Sequence[str]) -> DataFrame:
    """Rows of the documents that did not fail."""
    return rows if failed.isEmpty() else narrow_join(rows, failed.select(*DOC_KEYS), DOC_KEYS, spread_by, "left_anti")


def _timed_out(split: DataFrame, timeout_seconds: float | None) -> DataFrame | None:
    """Documents whose pages together took longer to chunk than allowed."""
    if timeout_seconds is None:
        return None
    spent = split.groupBy(*DOC_KEYS).agg(F.sum(F.coalesce("seconds", F.lit(0.0))).alias("spent"))
    return spent.filter(F.col("spent") > timeout_seconds).select(*DOC_KEYS)
