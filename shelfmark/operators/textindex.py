"""Full-text index as a (token, id) table, and matching over it."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions.text import words
from shelfmark.operators import joins
from shelfmark.operators.arrays import unnest

TOKEN_BUCKETS = 64
# Texts that a task indexes at least, about, when a write has few.
WRITER_TEXTS = 2_048
SCORE_DIGITS = 9

# Stored lists: a row per word and part with the numbers of its texts, and in the bucket after the others one row per part with the ids of all its texts.
LISTS = "token string, part bigint, texts array<int>, ids array<string>"
# Postings of a part, at most, unless a single text has more.
PART_POSTINGS = 2_000_000


def postings(corpus: DataFrame, text: str = "page_content", id_col: str = "id") -> DataFrame:
    """One row per distinct token of each text: ``token, id``.

    A row-wise explode: the ids of a frequent token are never gathered.
    """
    found = unnest(corpus.select(id_col, text), F.array_distinct(words(F.col(text))), "token")
    return found.select("token", id_col)


def document_frequency(index: DataFrame) -> DataFrame:
    return index.groupBy("token").agg(F.count("*").alias("n_docs"))


def write_index(index: DataFrame, path: str, id_col: str = "id", writers: int | None = None) -> None:
    """Store postings by token bucket, sorted by token, so a lookup reads one bucket and skips most of it.

    Every task writes what it has, so no posting is moved, and the rows of a
    frequent token stay with the tasks of their texts. ``writers`` bounds the
    tasks, and thereby the files of a bucket.
    """
    bucket = F.pmod(F.xxhash64("token"), F.lit(TOKEN_BUCKETS)).cast("int")
    laid_out = index.select("token", id_col, bucket.alias("bucket"))
    if writers is not None:
        laid_out = laid_out.coalesce(max(1, writers))
    laid_out.sortWithinPartitions("bucket", "token").write.mode("overwrite").partitionBy("bucket").parquet(path)


def _parts(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Rows (id, words) that have words, in parts of up to ``most`` words; a text with more stands alone."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        sizes = pc.fill_null(pc.list_value_length(batch.column("words")), 0)
        batch, sizes = batch.filter(pc.greater(sizes, 0)), sizes.to_numpy(zero_copy_only=False)
        so_far, at = np.cumsum(sizes[sizes > 0], dtype=np.int64), 0
        while at < len(batch):
            before = int(so_far[at - 1]) if at else 0
            to = int(np.searchsorted(so_far, before + most - n, side="right"))
            if not held:
                to = max(to, at + 1)
            if to > at:
                held.append(batch.slice(at, to - at))
                n, at = n + int(so_far[to - 1]) - before, to
            if at < len(batch):
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _part_lists(rows: pa.Table, part: int) -> Iterator[pa.RecordBatch]:
    """The lists of one part, and its ids."""
    found = rows.column("words").combine_chunks()
    sizes = pc.list_value_length(found).to_numpy(zero_copy_only=False)
    coded = found.flatten().dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(code, kind="stable")
    code, text = code[order], np.repeat(np.arange(len(rows), dtype=np.int32), sizes)[order]
    first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    texts = pa.ListArray.from_arrays(pa.array(np.r_[first, len(code)].astype(np.int32)), pa.array(text))
    ids = pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows.column("id").combine_chunks())
    words_of, numbers = coded.dictionary.take(pa.array(code[first])), pa.array(np.full(len(first), part))
    names = ["token", "part", "texts", "ids"]
    yield pa.RecordBatch.from_arrays([words_of, numbers, texts, pa.nulls(len(first), ids.type)], names=names)
    yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.string()), pa.array([part]), pa.nulls(1, texts.type), ids], names=names)


def write_lists(
    corpus: DataFrame, path: str, text: str = "page_content", id_col: str = "id", writers: int | None = None, most: int = PART_POSTINGS
) -> None:
    """Store the postings of ``corpus`` by token bucket, sorted by token, without a row per posting.

    Every task makes lists of text numbers out of a bounded part of its texts
    at a time, so no posting is moved, and what it sorts are short rows; an id
    is stored once, not with every word. ``writers`` as in ``write_index``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for i, rows in enumerate(_parts(batches, most)):
            yield from _part_lists(rows, first + i)

    rows = corpus.select(F.col(id_col).cast("string").alias("id"), F.array_distinct(words(F.col(text))).alias("words"))
    if writers is not None:
        rows = rows.coalesce(max(1, writers))
    bucket = F.pmod(F.xxhash64("token"), F.lit(TOKEN_BUCKETS))
    bucket = F.when(F.col("token").isNull(), F.lit(TOKEN_BUCKETS)).otherwise(bucket).cast("int")
    laid_out = rows.mapInArrow(run, LISTS).withColumn("bucket", bucket)
    laid_out.sortWithinPartitions("bucket", "token").write.mode("overwrite").partitionBy("bucket").parquet(path)


def open_lists(stored: DataFrame, by: Sequence[str] = (), wanted: DataFrame | None = None) -> DataFrame:
    """Postings ``token, id, bucket`` and ``by`` out of stored lists (``LISTS`` and ``bucket``); a part belongs to one value of ``by``.

    With ``wanted`` (distinct ``token``) those of these words alone: only their
    lists are opened and meet the ids.
    """
    lists = stored.filter(F.col("bucket") < TOKEN_BUCKETS).select("token", "bucket", *by, "part", "texts")
    if wanted is not None:
        lists = joins.narrow_join(lists, wanted.select("token"), ["token"], ["part"], "left_semi")
    numbered = unnest(lists, F.col("texts"), "_text").drop("texts")
    held = stored.filter(F.col("bucket") == TOKEN_BUCKETS).select(*by, "part", "ids")
    ids = unnest(held, F.col("ids"), "id", "_text").drop("ids")
    return numbered.join(ids, [*by, "part", "_text"]).select("token", "id", "bucket", *by)


def query_words(queries: DataFrame) -> DataFrame:
    """The words of all queries (``text``), once each: ``token``."""
    asked = queries.select(F.array_distinct(words(F.col("text"))).alias("_words"))
    return unnest(asked, F.col("_words"), "token").select("token").distinct()


def lookup(index: DataFrame, tokens: list[str]) -> DataFrame:
    """Postings of a few tokens; on a stored index only their buckets are read."""
    found = index.filter(F.col("token").isin(*tokens))
    if "bucket" in index.columns:
        wanted = [F.pmod(F.xxhash64(F.lit(t)), F.lit(TOKEN_BUCKETS)).cast("int") for t in tokens]
        found = found.filter(F.col("bucket").isin(*wanted))
    return found


def lexical_match(
    index: DataFrame,
    queries: DataFrame,
    mode: str = "and",
    id_col: str = "id",
    query_col: str = "query_id",
    k: int | None = None,
) -> DataFrame:
    """Texts that hold all (``and``) or any (``or``) of a query's words.

    ``queries`` has ``query_col`` and ``text``. The result has ``query, id,
    n_matched`` and, with ``k``, the ``score`` and ``rank`` of the ``k`` best
    texts of each query: a matched word counts the less the more texts have it,
    and ties go to the smaller id.

    All words are only looked for in texts that hold the query's rarest one.
    """
    if mode not in ("and", "or"):
        raise ValueError(f"unknown mode: {mode}")
    asked = queries.select(query_col, F.array_distinct(words(F.col("text"))).alias("_words"))
    wanted = unnest(asked, F.col("_words"), "token").select(query_col, F.size("_words").alias("_n"), "token")
    small = joins.is_small(wanted)

    def meet(rows: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
        """Postings with (a part of) the wanted words, which were measured once."""
        if small:
            return rows.join(F.broadcast(right), ["token"], how)
        return joins.skew_join(rows, right, ["token"], [id_col], how)

    held = meet(index.select("token", id_col), wanted.select("token").distinct(), "left_semi")
    wanted = wanted.join(document_frequency(held), "token", "left")
    match = _all_words if mode == "and" else _any_word
    matched = match(held, wanted, meet, id_col, query_col)
    if k is None:
        return matched.select(query_col, id_col, "n_matched")
    best = Window.partitionBy(query_col).orderBy(F.desc("score"), id_col)
    ranked = matched.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select(query_col, id_col, "n_matched", "score", "rank")


def _score(of: Column) -> Column:
    return F.round(F.sum(F.lit(1.0) / of), SCORE_DIGITS)


def _any_word(held: DataFrame, wanted: DataFrame, meet: Callable[..., DataFrame], id_col: str, query_col: str) -> DataFrame:
    """What meets per (query, id) is one row per query word at most, already summed on the map side."""
    found = meet(held, wanted.filter("n_docs is not null"))
    return found.groupBy(query_col, id_col).agg(F.count("*").alias("n_matched"), _score(F.col("n_docs")).alias("score"))


def _all_words(held: DataFrame, wanted: DataFrame, meet: Callable[..., DataFrame], id_col: str, query_col: str) -> DataFrame:
    # A query has few words: its window is small.
    whole = Window.partitionBy(query_col)
    rarest = whole.orderBy("n_docs", "token")
    possible = (
        wanted.withColumn("_score", F.round(F.sum(F.lit(1.0) / F.col("n_docs")).over(whole), SCORE_DIGITS))
        .withColumn("_known", F.count("n_docs").over(whole))
        .withColumn("_place", F.row_number().over(rarest))
        .filter(F.col("_known") == F.col("_n"))
    )
    first = possible.filter("_place = 1").select("token", query_col, "_n", "_score")
    candidates = meet(held, first).select(query_col, id_col, "_n", "_score")
    others = possible.filter("_place > 1").select(query_col, "token")
    rest = candidates.filter("_n > 1").join(others, query_col).join(held, ["token", id_col], "left_semi")
    complete = rest.groupBy(query_col, id_col, "_n", "_score").agg(F.count("*").alias("_found"))
    complete = complete.filter(F.col("_found") == F.col("_n") - 1).select(query_col, id_col, "_n", "_score")
    both = candidates.filter("_n = 1").unionByName(complete)
    return both.select(query_col, id_col, F.col("_n").cast("bigint").alias("n_matched"), F.col("_score").alias("score"))
