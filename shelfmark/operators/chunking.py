"""Pages -> chunks."""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.text import sentences
from shelfmark.operators.arrays import unnest
from shelfmark.operators.embedding import Embedder, HashedEmbedder
from shelfmark.operators.joins import narrow_join
from shelfmark.operators.limits import LimitedCalls, OverTime
from shelfmark.operators.ordinals import running_offset
from shelfmark.schemas import DOC_KEYS, ChunkParams
from shelfmark.session import stage

# Distances are compared after rounding: equal windows must give exactly equal distances.
DISTANCE_DIGITS = 9

_SPAN = "struct<first: int, n: int, start_index: int>"
_SPLIT = f"struct<spans: array<{_SPAN}>, seconds: double, timed_out: boolean, error: string>"
_SPLIT_TYPE = pa.struct(
    [
        ("spans", pa.list_(pa.struct([("first", pa.int32()), ("n", pa.int32()), ("start_index", pa.int32())]))),
        ("seconds", pa.float64()),
        ("timed_out", pa.bool_()),
        ("error", pa.string()),
    ]
)
# Pages whose sentences are Python strings at a time.
_SLICE_PAGES = 32


def fixed_windows(text: Column, size: int, overlap: int) -> Column:
    """Pieces of ``size`` characters, each starting ``overlap`` before the end of the one before.

    One regex pass over the text: ``substring`` would count characters from the
    start again for every piece.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be smaller than size")
    # A further piece is due only while more than the overlap is left.
    pattern = f"(?s)(?=(.{{{overlap + 1},{size}}})).{{1,{size - overlap}}}"
    return F.when(F.length(text) > size, F.regexp_extract_all(text, F.lit(pattern), F.lit(1))).otherwise(
        F.array(text)
    )


def window_count(length: Column, size: int, overlap: int) -> Column:
    """How many fixed windows a text of this length has."""
    further = F.ceil((length - size) / (size - overlap))
    return F.when(length.isNotNull(), F.greatest(further, F.lit(0)) + 1)


def window_distances(vectors: np.ndarray) -> np.ndarray:
    """Cosine distance between consecutive vectors."""
    left, right = vectors[:-1], vectors[1:]
    scale = np.sqrt((left * left).sum(axis=1) * (right * right).sum(axis=1))
    similar = np.divide((left * right).sum(axis=1), scale, out=np.zeros(len(left)), where=scale > 0)
    return np.round(1.0 - similar, DISTANCE_DIGITS)


def merge_spans(lengths: Sequence[int], breaks: np.ndarray, min_size: int) -> list[tuple[int, int, int]]:
    """``(first sentence, sentence count, start index)`` per chunk.

    A break closes the chunk when its text has reached ``min_size``; the rest
    of the page is the last chunk.
    """
    spans, first, size, offset = [], 0, 0, 0
    for i, length in enumerate(lengths):
        size += length if i == first else length + 1
        if i == len(lengths) - 1 or (breaks[i] and size >= min_size):
            spans.append((first, i + 1 - first, offset))
            first, offset, size = i + 1, offset + size, 0
    return spans


def _split_column(
    found: Column,
    lengths: Column,
    embedder: Embedder,
    params: ChunkParams,
    timeout_seconds: float | None,
    isolate: bool,
) -> Column:
    def distances_of(parts: Sequence[str]) -> np.ndarray:
        return window_distances(embedder.embed_windows(parts, params.buffer_size))

    def split(parts: Sequence[str], sizes: Sequence[int], limited: LimitedCalls) -> tuple:
        began = time.monotonic()
        try:
            distances = distances_of(parts) if timeout_seconds is None else limited(timeout_seconds, parts)
        except OverTime:
            return None, max(timeout_seconds, time.monotonic() - began), True
        limit = np.round(np.percentile(distances, params.breakpoint_percentile), DISTANCE_DIGITS)
        breaks = np.append(distances > limit, False)
        return merge_spans(sizes, breaks, params.min_chunk_size), time.monotonic() - began, False

    def rows_of(texts: pa.Array, sizes: pa.Array, limited: LimitedCalls) -> Iterator[tuple]:
        # Few pages at a time are Python strings.
        for at in range(0, len(texts), _SLICE_PAGES):
            some = texts.slice(at, _SLICE_PAGES).to_pylist(), sizes.slice(at, _SLICE_PAGES).to_pylist()
            for parts, counts in zip(*some):
                if parts is None:
                    yield None, 0.0, False, None
                    continue
                try:
                    spans, spent, late = split(parts, counts, limited)
                except Exception as exc:
                    if not isolate:
                        raise
                    yield None, 0.0, False, f"{type(exc).__name__}: {exc}"
                    continue
                named = spans and [{"first": a, "n": n, "start_index": s} for a, n, s in spans]
                yield named, spent, late, None

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        # With a limit, the model runs in a process of its own, which can be ended.
        limited = LimitedCalls(distances_of, getattr(embedder, "load", lambda: None))
        try:
            for texts, sizes in batches:
                rows = [dict(zip(_SPLIT_TYPE.names, row)) for row in rows_of(texts, sizes, limited)]
                yield pa.array(rows, _SPLIT_TYPE)
        finally:
            limited.close()

    prepared = F.transform(found, lambda s: embedder.prepare(s))
    return F.arrow_udf(run, _SPLIT)(prepared, lengths)


def semantic_pieces(
    pages: DataFrame,
    params: ChunkParams = ChunkParams(),
    embedder: Embedder | None = None,
    timeout_seconds: float | None = None,
    isolate: bool = False,
) -> DataFrame:
    """``pages`` with ``pieces`` (``array<struct<text, start_index>>``), ``seconds``, ``timed_out``, ``error``.

    With ``isolate``, a page the embedder fails on has an error and no pieces;
    otherwise the job fails.

    With ``timeout_seconds`` a page is given up after the model batch in which
    its time ran out; it is then one piece and marked ``timed_out``.

    Works inside each page, so it moves no data. A page of at most
    ``buffer_size + 1`` sentences has identical windows everywhere, hence no
    break: it is one piece and its text never leaves the JVM.
    """
    embedder = embedder or HashedEmbedder()
    split = pages.withColumn("_s", sentences(F.col("text")))
    long_page = F.size("_s") > F.lit(params.buffer_size + 1)
    split = split.withColumn(
        "_split",
        _split_column(
            F.when(long_page, F.col("_s")),
            F.when(long_page, F.transform("_s", lambda s: F.length(s))),
            embedder,
            params,
            timeout_seconds,
            isolate,
        ),
    )
    whole = F.array(F.struct(F.lit(0).alias("first"), F.size("_s").alias("n"), F.lit(0).alias("start_index")))
    spans = F.coalesce("_split.spans", whole.cast(f"array<{_SPAN}>"))
    pieces = F.transform(
        spans,
        lambda p: F.struct(
            F.array_join(F.slice(F.col("_s"), p["first"] + 1, p["n"]), " ").alias("text"),
            p["start_index"].alias("start_index"),
        ),
    )
    return (
        split.withColumn("pieces", F.when(F.col("text").isNotNull() & F.col("_split.error").isNull(), pieces))
        .withColumn("seconds", F.col("_split.seconds"))
        .withColumn("timed_out", F.col("_split.timed_out"))
        .withColumn("error", F.col("_split.error"))
        .drop("_s", "_split")
    )


def split_oversize(pieces: Column, params: ChunkParams, min_length: int | None = None) -> Column:
    """Pieces above the maximum cut into fixed windows, which keep the start index of their piece.

    ``min_length`` takes the place of the minimum in the size of the overlap.
    """
    cut = F.transform(
        pieces,
        lambda p: F.transform(
            fixed_windows(p["text"], params.target_max_chunk_size, params.overlap_for(min_length)),
            lambda w: F.struct(w.alias("text"), p["start_index"].alias("start_index")),
        ),
    )
    return F.flatten(cut)


def number_chunks(
    paged: DataFrame, pieces: str, doc: Sequence[str] = DOC_KEYS, count: Column | None = None
) -> DataFrame:
    """One row per piece, with ``chunk_index`` running over the pages of a document from 0.

    ``count`` is a cheaper way to get at the number of pieces, if there is one.
    """
    size = F.coalesce(F.size(pieces) if count is None else count, F.lit(0))
    # Offsets come from keys and counts alone; a list that fits goes to the pages, so that no text is moved.
    counts = paged.select(*doc, "page", size.alias("_size"))
    offsets = running_offset(counts, doc, "page", F.col("_size"), "_offset").drop("_size")
    placed = narrow_join(paged, offsets, [*doc, "page"], ["page"])
    kept = [c for c in paged.columns if c not in (pieces, "text")]
    return unnest(placed, F.col(pieces), "_piece", "_pos").select(
        *kept,
        (F.col("_offset") + F.col("_pos")).cast("int").alias("chunk_index"),
        F.col("_piece.start_index").alias("start_index"),
        F.col("_piece.text").alias("text"),
    )


def chunk_pages(
    pages: DataFrame,
    params: ChunkParams = ChunkParams(),
    embedder: Embedder | None = None,
    doc: Sequence[str] = DOC_KEYS,
    min_length: int | None = None,
) -> DataFrame:
    """Semantic pieces, oversize split, running index: one row per chunk.

    ``min_length`` is the least length that is expected of a chunk: it sets the
    overlap of cut pieces (and what ``is_outlier`` flags), not where sentences
    are joined.

    The pieces are written out before they are numbered: numbering reads their
    counts and their texts, and embedding sentences twice costs more.
    """
    split = semantic_pieces(pages, params, embedder).drop("seconds", "timed_out", "error")
    split = split.withColumn("pieces", split_oversize(F.col("pieces"), params, min_length)).drop("text")
    return number_chunks(stage(split, "pieces"), "pieces", doc)


def fixed_chunks(
    pages: DataFrame,
    params: ChunkParams = ChunkParams(),
    doc: Sequence[str] = DOC_KEYS,
    min_length: int | None = None,
) -> DataFrame:
    """Fixed windows over the whole page text, without looking at sentences."""
    whole = F.array(F.struct(F.col("text").alias("text"), F.lit(0).alias("start_index")))
    pieces = F.when(F.col("text").isNotNull(), split_oversize(whole, params, min_length))
    count = window_count(F.length("text"), params.target_max_chunk_size, params.overlap_for(min_length))
    return number_chunks(pages.withColumn("pieces", pieces), "pieces", doc, count)


def is_outlier(text: Column, params: ChunkParams, min_length: int | None = None) -> Column:
    """Chunk length outside the expected range; 0 or no ``min_length`` means the default."""
    size = F.length(text)
    return (size < (min_length or params.min_chunk_size)) | (size > params.target_max_chunk_size)


def outlier_summary(chunks: DataFrame, params: ChunkParams, min_length: int | None = None) -> DataFrame:
    """One row: outliers, all chunks, and the shortest and longest outlier."""
    flagged = chunks.select(F.length("text").alias("n"), is_outlier(F.col("text"), params, min_length).alias("odd"))
    odd_length = F.when(F.col("odd"), F.col("n"))
    return flagged.agg(
        F.count_if("odd").alias("n_outliers"),
        F.count("*").alias("n_chunks"),
        F.min(odd_length).alias("shortest"),
        F.max(odd_length).alias("longest"),
    )
