"""Ranked lexical search over stored postings, with windows of texts that are ruled out unread.

Layout below one root:

    stats/             one row: texts, words, windows, type of the ids
    blocks/bucket=<b>/ one row per word and window: how many texts, the most
                       frequent and the shortest of them, and the postings

A window is a few hundred texts that share a hash of their id. The largest
count and the smallest length bound what a word can add to any text of a
window, whatever the average length is by now. A search sums these bounds,
without the postings, scores the most promising windows of each query first,
and reads of the others only those whose bound reaches the k-th score so far.
The result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.text import words
from shelfmark.operators.arrays import unnest
from shelfmark.operators.joins import is_small, skew_join
from shelfmark.operators.knn import keep_best
from shelfmark.session import Steps, empty, path_exists, stage

# Texts of a window, on average.
WINDOW = 512
BUCKETS = 64
# How a repeated word and the length of a text count (the usual parameters of BM25).
SATURATION, LENGTH = 1.2, 0.75
SCORE_DIGITS = 6
# Windows per query that are scored in the first rounds; the last round takes all that may matter.
ROUNDS = (8,)
# Reciprocal rank fusion.
FUSION = 60

# Texts that one task of a build indexes, about, and words that it holds at a time.
TASK_TEXTS = 16_384
_CHUNK_WORDS = 2_000_000
# Words of queries that are scored together in a window.
_QUERY_WORDS = 4_096

_STATS = "n_texts bigint, n_words bigint, windows bigint, id_type string"


def _weight(count: Column, length: Column, average: float) -> Column:
    """What a word adds to a text before its rarity counts."""
    count = count.cast("double")
    return count * (SATURATION + 1) / (count + SATURATION * (1 - LENGTH + LENGTH * length / average))


def _rarity(texts: Column, n_texts: int) -> Column:
    return F.log(1 + (F.lit(float(n_texts)) - texts + 0.5) / (texts + 0.5))


def _texts_type(kind: str) -> str:
    return f"texts array<struct<id: {kind}, count: int, length: int>>"


def _whole_windows(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Rows (id, window, words) that come by window, in parts of about ``most`` words that end where a window does.

    A window with more words than that is cut: its bounds are then those of its parts in sum.
    """
    held: list[pa.RecordBatch] = []
    n_words = 0
    for batch in batches:
        sizes = pc.fill_null(pc.list_value_length(batch.column("words")), 0).to_numpy(zero_copy_only=False)
        window = batch.column("window").to_numpy(zero_copy_only=False)
        at, so_far = 0, np.cumsum(sizes)
        edges = np.flatnonzero(np.r_[True, window[1:] != window[:-1]]) if len(window) else []
        for edge in edges:
            # A window may have begun in the batch before.
            new = edge > 0 or not held or held[-1].column("window")[-1].as_py() != window[0]
            if new and n_words + (so_far[edge - 1] if edge else 0) - (so_far[at - 1] if at else 0) >= most:
                if edge > at:
                    held.append(batch.slice(at, edge - at))
                yield pa.Table.from_batches(held)
                held, n_words, at = [], 0, edge
        if len(batch) > at:
            held.append(batch.slice(at))
            n_words += int(so_far[-1] - (so_far[at - 1] if at else 0))
        if n_words >= 4 * most:
            yield pa.Table.from_batches(held)
            held, n_words = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _window_blocks(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """The blocks of whole windows: one row per word and window, with its postings in the order of the rows."""
    found = rows.column("words").combine_chunks()
    sizes = pc.fill_null(pc.list_value_length(found), 0).to_numpy(zero_copy_only=False)
    if not sizes.sum():
        return
    coded = found.flatten().dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    window = rows.column("window").to_numpy()
    number = np.cumsum(np.r_[False, window[1:] != window[:-1]])
    # By word, window and text; the rows of a window stand together already.
    text, count = np.unique(code * len(rows) + np.repeat(np.arange(len(rows)), sizes), return_counts=True)
    code, text = np.divmod(text, len(rows))
    first = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (number[text[1:]] != number[text[:-1]])])
    ids, length = rows.column("id").combine_chunks(), sizes.astype(np.int32)
    count = count.astype(np.int32)
    ends = np.r_[first[1:], len(code)]
    # In parts, as the lists of a batch are copied once more on their way.
    steps = np.unique(np.r_[np.searchsorted(first, np.arange(0, len(code), 200_000)), len(first)])
    for a, b in zip(steps[:-1], steps[1:]):
        lo, hi = first[a], ends[b - 1]
        part, starts = text[lo:hi], first[a:b] - lo
        postings = pa.StructArray.from_arrays(
            [ids.take(pa.array(part)), pa.array(count[lo:hi]), pa.array(length[part])], names=["id", "count", "length"]
        )
        yield pa.RecordBatch.from_arrays(
            [
                coded.dictionary.take(pa.array(code[first[a:b]])),
                pa.array(window[text[first[a:b]]]),
                pa.array((ends[a:b] - first[a:b]).astype(np.int32)),
                pa.array(np.maximum.reduceat(count[lo:hi], starts)),
                pa.array(np.minimum.reduceat(length[part], starts)),
                pa.array(np.add.reduceat(count[lo:hi].astype(np.int64), starts)),
                pa.ListArray.from_arrays(pa.array(np.r_[starts, hi - lo].astype(np.int32)), postings),
            ],
            names=["token", "window", "n", "most", "shortest", "total", "texts"],
        )


class _Window:
    """The opened postings of one window, and the scores of its texts for the queries that ask it."""

    def __init__(self, average: float, k: int) -> None:
        self.average, self.k = average, k
        self.tokens: list[pa.Array] = []
        self.texts: list[pa.Array] = []
        self.ready = False

    def hold(self, batch: pa.RecordBatch) -> None:
        self.tokens.append(batch.column("token"))
        self.texts.append(batch.column("texts"))

    def _weigh(self) -> None:
        """Postings by word: the number of their text, and what the word adds to it before its rarity counts."""
        lists = pa.concat_arrays(self.texts)
        fields = lists.flatten()
        # An id that several texts have is one hit.
        coded = fields.field("id").dictionary_encode(null_encoding="encode")
        self.ids, self.text = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        count, length = (fields.field(f).to_numpy(zero_copy_only=False).astype(float) for f in ("count", "length"))
        self.weight = count * (SATURATION + 1) / (count + SATURATION * (1 - LENGTH + LENGTH * length / self.average))
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        edges = np.r_[0, np.cumsum(sizes)]
        self.spans: dict[str, list[tuple[int, int]]] = {}
        for i, token in enumerate(pa.concat_arrays(self.tokens).to_pylist()):
            self.spans.setdefault(token, []).append((edges[i], edges[i + 1]))
        self.tokens, self.texts, self.ready = [], [], True

    def best(self, batch: pa.RecordBatch) -> tuple[pa.Array, pa.Array, np.ndarray]:
        """Row of a query, id, score: all texts not worse than the query's k-th best here and than ``kth``."""
        if not self.ready:
            self._weigh()
        words, rarity, kth = (batch.column(c).to_pylist() for c in ("tokens", "rarity", "kth"))
        number: dict[str, int] = {}
        rows, columns, values = [], [], []
        for i, (ws, rs) in enumerate(zip(words, rarity)):
            for w, r in zip(ws, rs):
                if w in self.spans:
                    rows.append(i)
                    columns.append(number.setdefault(w, len(number)))
                    values.append(r)
        asked, held = np.zeros((len(words), len(number))), np.zeros((len(number), len(self.ids)))
        asked[rows, columns] = values
        for w, at in number.items():
            for a, b in self.spans[w]:
                np.add.at(held[at], self.text[a:b], self.weight[a:b])
        score = asked @ held
        least = np.array([-np.inf if x is None else x for x in kth])[:, None]
        if self.k < len(self.ids):
            least = np.maximum(least, np.partition(score, len(self.ids) - self.k, axis=1)[:, [len(self.ids) - self.k]])
        # Scores are rounded later on.
        query, text = np.nonzero((score > 0) & (score >= least - 2 * 10.0**-SCORE_DIGITS))
        return batch.column("query_id").take(pa.array(query)), self.ids.take(pa.array(text)), score[query, text]


@dataclass(frozen=True)
class Ranked:
    """``hits``: query_id, id, score, rank. ``read``: query_id, postings that were read, postings of all its words."""

    hits: DataFrame
    read: DataFrame


class RankedIndex:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def exists(self) -> bool:
        return path_exists(self.spark, f"{self.root}/stats")

    def stats(self) -> Row:
        return self.spark.read.schema(_STATS).parquet(f"{self.root}/stats").collect()[0]

    def blocks(self) -> DataFrame:
        """token, window, n, most, shortest, texts: array of (id, count, length)."""
        kind = self.stats().id_type
        schema = f"token string, window bigint, n int, most int, shortest int, {_texts_type(kind)}, bucket int"
        return self.spark.read.schema(schema).parquet(f"{self.root}/blocks")

    def build(self, corpus: DataFrame, text: str = "page_content", id_col: str = "id", window: int = WINDOW) -> None:
        """Index ``corpus`` (unique ids). The texts are read once and counted where they lie."""
        if window < 1:
            raise ValueError("a window holds at least one text")
        kind = corpus.schema[id_col].dataType.simpleString()
        n_texts = corpus.count()
        windows = max(1, -(-n_texts // window))

        def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in _whole_windows(batches, _CHUNK_WORDS):
                yield from _window_blocks(rows)

        placed = corpus.select(F.col(id_col).alias("id"), F.pmod(F.xxhash64(id_col), F.lit(windows)).alias("window"), F.col(text).alias("text"))
        # Texts are moved once, to the task of their window; their words are never rows of a shuffle.
        tasks = max(-(-n_texts // TASK_TEXTS), min(self.spark.sparkContext.defaultParallelism, -(-n_texts // (TASK_TEXTS // 16))), 1)
        together = placed.repartition(tasks, "window").sortWithinPartitions("window")
        made = together.select("id", "window", words(F.col("text")).alias("words")).mapInArrow(
            index, f"token string, window bigint, n int, most int, shortest int, total bigint, {_texts_type(kind)}"
        )
        made = made.withColumn("bucket", F.pmod(F.xxhash64("token"), F.lit(BUCKETS)).cast("int"))
        made.sortWithinPartitions("bucket", "token", "window").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/blocks")
        written = self.spark.read.schema("total bigint").parquet(f"{self.root}/blocks")
        n_words = written.agg(F.sum("total")).first()[0] or 0
        row = [(n_texts, n_words, windows, kind)]
        self.spark.createDataFrame(row, _STATS).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/stats")

    def search(self, queries: DataFrame, k: int = 20, query_col: str = "query_id", rounds: Sequence[int] = ROUNDS) -> Ranked:
        """The ``k`` best texts for the words of each query (``query_col, text``), by BM25; ties go to the smaller id.

        A word counts once, however often the query has it. Texts without any
        of the words are no hits.
        """
        if k <= 0:
            raise ValueError("k must be positive")
        stats = self.stats()
        query_kind = queries.schema[query_col].dataType.simpleString()
        if not stats.n_words:
            nothing = empty(self.spark, f"{query_col} {query_kind}, id {stats.id_type}, score double, rank int")
            return Ranked(nothing, empty(self.spark, f"{query_col} {query_kind}, n_read bigint, n_all bigint"))
        average = stats.n_words / stats.n_texts
        steps = Steps()
        asked = queries.select(F.col(query_col).alias("query_id"), F.array_distinct(words(F.col("text"))).alias("_words"))
        wanted = steps.stage(unnest(asked, F.col("_words"), "token").select("query_id", "token"), "wanted")
        small, blocks = is_small(wanted), self.blocks()
        if wanted.select("token").distinct().count() <= 4 * BUCKETS:
            named = [r["b"] for r in wanted.select(F.pmod(F.xxhash64("token"), F.lit(BUCKETS)).cast("int").alias("b")).distinct().collect()]
            blocks = blocks.filter(F.col("bucket").isin(named))

        def meet(rows: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
            return rows.join(F.broadcast(right), on) if small else skew_join(rows, right, on, ["window"])

        tokens = wanted.select("token").distinct()
        outline = steps.stage(meet(blocks.select("token", "window", "n", "most", "shortest"), tokens, ["token"]), "outline")
        rarity = outline.groupBy("token").agg(F.sum("n").alias("n_token"))
        rarity = rarity.select("token", _rarity(F.col("n_token"), stats.n_texts).alias("rarity"))
        wanted = steps.stage(wanted.join(rarity, "token"), "weighted")
        bound = F.sum(F.col("rarity") * _weight(F.col("most"), F.col("shortest"), average))
        per_window = meet(outline, wanted, ["token"]).groupBy("query_id", "window").agg(bound.alias("score"), F.sum("n").alias("n"))
        left = steps.stage(per_window, "windows")
        best: DataFrame | None = None
        kth: DataFrame | None = None
        read: list[DataFrame] = []
        for i, take in enumerate([*rounds, None]):
            chosen = left if take is None else left.join(keep_best(left, take, "DOT", "window", "query_id").select("query_id", "window"), ["query_id", "window"])
            chosen = steps.stage(chosen, f"round-{i}")
            read.append(chosen)
            scored = self._scored(blocks, chosen, wanted, kth, average, k, query_kind, stats.id_type)
            best = steps.stage(keep_best(scored if best is None else best.unionByName(scored), k, "DOT", "id", "query_id").drop("rank"), f"best-{i}")
            if take is not None:
                # The k-th score so far; what a window's bound does not reach cannot change the result.
                reached = best.groupBy("query_id").agg(F.min("score").alias("kth"), F.count("*").alias("hits")).filter(F.col("hits") >= k)
                rest = left.join(chosen.select("query_id", "window"), ["query_id", "window"], "left_anti").join(reached, "query_id", "left")
                slack = 2 * 10.0**-SCORE_DIGITS
                kth = steps.stage(reached.select("query_id", "kth"), f"kth-{i}")
                left = steps.stage(rest.filter(F.col("kth").isNull() | (F.col("score") + slack >= F.col("kth"))).select(*left.columns), f"left-{i}")
        hits = stage(keep_best(best, k, "DOT", "id", "query_id"), "hits")
        total = per_window.groupBy("query_id").agg(F.sum("n").alias("n_all"))
        opened = read[0]
        for more in read[1:]:
            opened = opened.unionByName(more)
        counts = total.join(opened.groupBy("query_id").agg(F.sum("n").alias("n_read")), "query_id")
        counts = stage(counts.select(F.col("query_id").alias(query_col), "n_read", "n_all"), "read")
        steps.release()
        return Ranked(hits.select(F.col("query_id").alias(query_col), "id", "score", "rank"), counts)

    @staticmethod
    def _scored(
        blocks: DataFrame, chosen: DataFrame, wanted: DataFrame, kth: DataFrame | None, average: float, k: int, query_kind: str, id_kind: str
    ) -> DataFrame:
        """Whole scores of the texts in the chosen windows that may be among the ``k`` best of the query.

        Postings go to the task of their window once, whatever number of
        queries asks it, and the queries of the window stream by them.
        """
        asked = wanted.groupBy("query_id").agg(F.collect_list("token").alias("tokens"), F.collect_list("rarity").alias("rarity"))
        asked = asked.withColumn("kth", F.lit(None).cast("double")) if kth is None else asked.join(kth, "query_id", "left")
        pairs = chosen.select("query_id", "window")
        pairs = pairs.join(F.broadcast(asked), "query_id") if is_small(wanted) else pairs.join(asked, "query_id")
        # Postings are read for words and windows that are asked for.
        tokens, windows = wanted.select("token").distinct(), chosen.select("window").distinct()
        opened = blocks.select("token", "window", "texts")
        for needed, on in ((tokens, "token"), (windows, "window")):
            opened = opened.join(F.broadcast(needed) if is_small(needed) else needed, on, "left_semi")
        none = F.lit(None)
        held = opened.select(
            "window", F.lit(0).alias("kind"), "token", "texts", none.cast(query_kind).alias("query_id"),
            none.cast("array<string>").alias("tokens"), none.cast("array<double>").alias("rarity"), none.cast("double").alias("kth"),
        )
        queries = pairs.select(
            "window", F.lit(1).alias("kind"), none.cast("string").alias("token"), none.cast(opened.schema["texts"].dataType).alias("texts"),
            "query_id", "tokens", "rarity", "kth",
        )
        together = held.unionByName(queries).repartition("window").sortWithinPartitions("window", "kind")

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            current, at = None, None
            for batch in batches:
                keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("window", "kind")], axis=1)
                edges = np.r_[0, np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, len(keys)]
                for start, stop in zip(edges[:-1], edges[1:]):
                    part = batch.slice(start, stop - start)
                    if keys[start, 0] != at:
                        at, current = keys[start, 0], _Window(average, k)
                    if keys[start, 1] == 0:
                        current.hold(part)
                        continue
                    if not (current.ready or current.tokens):
                        continue
                    sizes = pc.list_value_length(part.column("tokens")).to_numpy(zero_copy_only=False)
                    group = np.cumsum(sizes) // _QUERY_WORDS
                    for rows in np.split(np.arange(len(part)), np.flatnonzero(group[1:] != group[:-1]) + 1):
                        found = current.best(part.slice(rows[0], len(rows)))
                        if len(found[2]):
                            yield pa.RecordBatch.from_arrays([found[0], found[1], pa.array(found[2])], names=["query_id", "id", "score"])

        scored = together.mapInArrow(score, f"query_id {query_kind}, id {id_kind}, score double")
        return scored.withColumn("score", F.round("score", SCORE_DIGITS))


def fused(found: Sequence[DataFrame], k: int = 30, query_col: str = "query_id", id_col: str = "id", constant: int = FUSION) -> DataFrame:
    """One list out of several ranked ones (``query_col, id_col, rank``): a hit counts 1 / (constant + rank) in each."""
    if not found:
        raise ValueError("nothing to fuse")
    rows = found[0].select(query_col, id_col, "rank")
    for more in found[1:]:
        rows = rows.unionByName(more.select(query_col, id_col, "rank"))
    score = F.round(F.sum(1.0 / (F.col("rank") + constant)), 9).alias("score")
    return keep_best(rows.groupBy(query_col, id_col).agg(score), k, "DOT", id_col, query_col)
