"""Point collections: appended segments with late removal of replaced points.

A write costs as much as the points it brings, not as the collection holds.
Layout below one root, with a single writer:

    collection/            one row: vector size and distance
    commits/               one row per finished write; ``base`` is the first segment that counts
    data/segment=<n>/      points
    words/segment=<n>/     full-text index; segments from before it have theirs in text/, a row per posting
    removed/segment=<n>/   ids whose points in earlier segments no longer count
    members/segment=<n>/   filters of its ids and items, so that a write opens only segments that may hold what it replaces
    cells/at=<n>/          vector index of the points that counted after segment n
    ranked/at=<n>/         ranked text index of the same
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.vectors import resolve_metric
from shelfmark.operators.joins import narrow_join
from shelfmark.operators.knn import keep_best, top_k
from shelfmark.operators.points import with_content
from shelfmark.operators.textindex import LISTS, WRITER_TEXTS, lexical_match, open_lists, query_words, write_lists
from shelfmark.plans.membership import FILTER, build_filter, may_hold
from shelfmark.plans.rankedindex import RankedIndex, fused
from shelfmark.plans.vectorindex import RECALL, VectorIndex
from shelfmark.schemas import DOC_KEYS, POINTS
from shelfmark.session import drop_path, empty, list_names, path_exists, stage

_COLLECTION = "name string, vector_size int, distance string"
_COMMITS = "segment bigint, base bigint, n_points bigint, n_removed bigint, created_at string, filtered boolean"
_REMOVED = "id string"
# Columns with a membership filter.
_MEMBERS = ("id", "qid")
_POSTINGS = "token string, id string, bucket int"


class Collection:
    def __init__(self, spark: SparkSession, root: str, name: str = "documents", distance: str = "COSINE") -> None:
        self.spark = spark
        self.name = name
        self.root = f"{root.rstrip('/')}/{name}"
        self.distance = resolve_metric(distance)

    def exists(self) -> bool:
        return path_exists(self.spark, f"{self.root}/collection")

    def describe(self) -> Row:
        return self.spark.read.schema(_COLLECTION).parquet(f"{self.root}/collection").collect()[0]

    def ensure(self, vector_size: int) -> None:
        """Create the collection unless it exists; an existing one must have the same vector size."""
        if not self.exists():
            row = [(self.name, vector_size, self.distance)]
            created = self.spark.createDataFrame(row, _COLLECTION).coalesce(1)
            created.write.mode("overwrite").parquet(f"{self.root}/collection")
            return
        known = self.describe()
        if known.vector_size != vector_size:
            raise ValueError(f"collection {self.name} holds vectors of size {known.vector_size}, not {vector_size}")
        self.distance = known.distance

    def recreate(self, vector_size: int) -> None:
        """Drop all points and start anew."""
        drop_path(self.spark, self.root)
        self.ensure(vector_size)

    def commits(self) -> DataFrame:
        if not path_exists(self.spark, f"{self.root}/commits"):
            return empty(self.spark, _COMMITS)
        return self.spark.read.schema(_COMMITS).parquet(f"{self.root}/commits")

    def _totals(self) -> Row:
        newest_base = F.coalesce(F.max("base").over(Window.partitionBy()), F.lit(0))
        counting = self.commits().withColumn("_base", newest_base).filter(F.col("segment") >= F.col("_base"))
        return counting.agg(
            F.coalesce(F.max("segment"), F.lit(-1)).alias("last"),
            F.coalesce(F.max("_base"), F.lit(0)).alias("base"),
            F.coalesce(F.sum("n_points"), F.lit(0)).alias("n_points"),
            F.coalesce(F.sum("n_removed"), F.lit(0)).alias("n_removed"),
        ).collect()[0]

    def size(self) -> int:
        """Number of points, from the commits alone."""
        totals = self._totals()
        return totals.n_points - totals.n_removed

    def _stored(self, name: str, schema: T.StructType | str, totals: Row) -> DataFrame:
        with_segment = empty(self.spark, schema).withColumn("segment", F.lit(0).cast("bigint")).schema
        path = f"{self.root}/{name}"
        if totals.last < 0 or not path_exists(self.spark, path):
            return empty(self.spark, with_segment)
        # A segment above the last commit is left over from a write that did not finish.
        stored = self.spark.read.schema(with_segment).parquet(path)
        return stored.filter(F.col("segment").between(totals.base, totals.last))

    def _live(self, columns: Sequence[str], within: Sequence[int] | None = None) -> DataFrame:
        """Points that count, with ``within`` those of some segments alone; other segments are not opened."""
        totals = self._totals()
        rows = self._within(self._stored("data", POINTS, totals).select(*columns, "segment"), within)
        return self._without_removed(rows, totals, within)

    def _within(self, rows: DataFrame, segments: Sequence[int] | None) -> DataFrame:
        return rows if segments is None else rows.filter(F.col("segment").isin(*segments))

    def _without_removed(self, rows: DataFrame, totals: Row, within: Sequence[int] | None = None) -> DataFrame:
        if totals.n_removed == 0 or within == []:
            return rows
        removed = self._stored("removed", _REMOVED, totals)
        if within is not None:
            removed = removed.filter(F.col("segment") > min(within))
        newest = removed.groupBy("id").agg(F.max("segment").alias("_removed_at"))
        # Which (id, segment) pairs are gone is settled on ids alone; a list that fits is sent to the points.
        segments = self._within(self._stored("data", POINTS, totals).select("id", "segment"), within)
        gone = segments.join(newest, "id").filter(F.col("segment") < F.col("_removed_at")).select("id", "segment")
        return narrow_join(rows, gone.distinct(), ["id", "segment"], ["id"], "left_anti")

    def points(self) -> DataFrame:
        """All current points. The text is stored once and put into the payload here."""
        live = self._live(POINTS.fieldNames()).drop("segment")
        return live.withColumn("payload", with_content(F.col("payload"), F.col("page_content")))

    def text_index(self, wanted: DataFrame | None = None) -> DataFrame:
        """Postings ``token, id, bucket`` of all current points; every write indexes what it brings.

        With ``wanted`` (distinct ``token``) those of these words alone, which
        is far cheaper: ids are looked up for them only.
        """
        totals = self._totals()
        found = open_lists(self._stored("words", f"{LISTS}, bucket int", totals), ["segment"], wanted)
        if path_exists(self.spark, f"{self.root}/text"):
            former = self._stored("text", _POSTINGS, totals)
            if wanted is not None:
                former = narrow_join(former, wanted, ["token"], ["id"], "left_semi")
            found = found.unionByName(former)
        return self._without_removed(found, totals).drop("segment")

    def search_text(self, queries: DataFrame, mode: str = "and", k: int | None = None) -> DataFrame:
        """Lexical matches among the current points, see ``lexical_match``."""
        return lexical_match(self.text_index(query_words(queries)), queries, mode, k=k)

    def index_vectors(self, cells: int | None = None, recall: float = RECALL) -> None:
        """Build the vector index of the current points; later writes are searched beside it until the next one."""
        totals = self._totals()
        index = VectorIndex(self.spark, f"{self.root}/cells/at={totals.last}")
        if not index.exists():
            drop_path(self.spark, index.root)  # left over from a build that did not finish
            index.build(self._live(["id", "vector"]).drop("segment"), self.describe().distance, cells, recall)

    def search_vectors(self, queries: DataFrame, k: int = 30, probes: int | None = None) -> DataFrame:
        """``query_id, id, score, rank`` among the current points, through the vector index where there is one.

        Points that came after the index are searched exactly; indexed points
        that have been replaced since are left out. Without an index, or after
        ``compact``, the search is exact.
        """
        totals, metric = self._totals(), self.describe().distance
        at = max((int(n.removeprefix("at=")) for n in list_names(self.spark, f"{self.root}/cells")), default=-1)
        index = VectorIndex(self.spark, f"{self.root}/cells/at={at}")
        if at < totals.base or not index.exists():
            return top_k(self._live(["id", "vector"]), queries, k, metric).hits
        if at == totals.last:
            return index.search(queries, k, probes)
        removed = self._stored("removed", _REMOVED, totals).filter(F.col("segment") > at)
        found = index.search(queries, k, probes, without=removed.select("id").distinct())
        later = top_k(self._live(["id", "vector"]).filter(F.col("segment") > at), queries, k, metric).hits
        return keep_best(found.drop("rank").unionByName(later.drop("rank")), k, metric, "id", "query_id")

    def search_ranked(self, queries: DataFrame, k: int = 30) -> DataFrame:
        """``query_id, id, score, rank`` of the texts that fit a query's words best; the first search after a write indexes."""
        totals = self._totals()
        index = RankedIndex(self.spark, f"{self.root}/ranked/at={totals.last}")
        if not index.exists():
            index.build(self._live(["id", "page_content"]))
        return index.search(queries, k).hits

    def search_hybrid(self, queries: DataFrame, k: int = 30, depth: int = 100) -> DataFrame:
        """Text and vector search together, for queries (query_id, text, vector): the best of both lists by reciprocal ranks."""
        by_text = self.search_ranked(queries.select("query_id", "text"), depth)
        by_vector = self.search_vectors(queries.select("query_id", "vector"), depth)
        return fused([by_text, by_vector], k)

    def upsert(
        self, points: DataFrame, replace_by: Sequence[str] | None = None, now: datetime | None = None
    ) -> int:
        """Add points with unique ids, replacing those with equal ids; returns how many were added.

        With ``replace_by`` (for example ``("qid", "component")``) every former
        point of the documents in the batch goes, so that a shorter new version
        leaves nothing behind.
        """
        self.ensure_ready()
        totals = self._totals()
        self._write_points(points, totals.last + 1)
        return self._index_and_commit(totals, totals.last + 1, replace_by, now)

    def upsert_sound(
        self, points: DataFrame, replace_by: Sequence[str] | None = None, now: datetime | None = None,
        keep: Callable[[DataFrame, str], DataFrame] = stage,
    ) -> DataFrame:
        """``upsert`` of points with an ``error``: a document with an error gets none of its points.

        Returns these documents and one of their errors (``qid, component,
        error``), written by ``keep``. The points are computed and written
        once; only if there are such documents, the others are copied.
        """
        self.ensure_ready()
        totals = self._totals()
        segment = totals.last + 1
        written = self._write_points(points, segment)
        failed = written.filter(F.col("error").isNotNull()).groupBy(*DOC_KEYS).agg(F.min("error").alias("error"))
        failed = keep(failed, "rejected")
        if not failed.isEmpty():
            sound = narrow_join(written, failed.select(*DOC_KEYS), DOC_KEYS, ["id"], "left_anti").drop("error")
            self._write_points(sound, segment + 1)
            drop_path(self.spark, self._data(segment))
            segment += 1
        self._index_and_commit(totals, segment, replace_by, now)
        return failed

    def _data(self, segment: int) -> str:
        return f"{self.root}/data/segment={segment}"

    def _write_points(self, points: DataFrame, segment: int) -> DataFrame:
        """Points as written to a segment that does not count yet, with their ``error`` if they have one."""
        fields = [*POINTS.fields, *[f for f in points.schema.fields if f.name == "error"]]
        checked = points.select(*[F.col(f.name).cast(f.dataType) for f in fields])
        vector = self._checked_vector(F.col("vector"))
        if "error" in points.columns:
            vector = F.when(F.col("error").isNull(), vector)
        bare = F.map_filter("payload", lambda key, _: key != "page_content")
        checked = checked.withColumns({"vector": vector, "payload": bare})
        checked.write.mode("overwrite").parquet(self._data(segment))
        return self.spark.read.schema(T.StructType(fields)).parquet(self._data(segment))

    def _index_and_commit(self, totals: Row, segment: int, replace_by: Sequence[str] | None, now: datetime | None) -> int:
        written = self.spark.read.schema(POINTS).parquet(self._data(segment))
        # The commit comes last: a reader sees points and postings of a segment together.
        n_points = written.count()
        self._write_words(written, segment, n_points)
        self._write_members(written, segment, n_points)
        n_removed = 0
        if totals.last >= 0:
            gone = f"{self.root}/removed/segment={segment}"
            # A write as large as all that is held meets most of it anyway.
            within = self.may_replace(written, replace_by) if n_points < totals.n_points else None
            self._replaced(written, replace_by, within).write.mode("overwrite").parquet(gone)
            n_removed = self.spark.read.schema(_REMOVED).parquet(gone).count()
        self._commit(segment, totals.base, n_points, n_removed, now)
        return n_points

    def _write_words(self, written: DataFrame, segment: int, n_points: int) -> None:
        write_lists(written, f"{self.root}/words/segment={segment}", writers=-(-n_points // WRITER_TEXTS))

    def _commit(self, segment: int, base: int, n_points: int, n_removed: int, now: datetime | None = None) -> None:
        row = (segment, base, n_points, n_removed, (now or datetime.now(timezone.utc)).isoformat(), True)
        self.spark.createDataFrame([row], _COMMITS).coalesce(1).write.mode("append").parquet(f"{self.root}/commits")

    def _write_members(self, written: DataFrame, segment: int, n_points: int) -> None:
        members = build_filter(written, _MEMBERS, n_points)
        members.write.mode("overwrite").parquet(f"{self.root}/members/segment={segment}")

    def may_replace(self, written: DataFrame, replace_by: Sequence[str] | None = None) -> list[int] | None:
        """The segments that may hold points which ``written`` replaces, by their filters; None if all may.

        Only segment numbers come to the driver. Segments from before there were filters count as holding everything.
        """
        doc = list(replace_by or ())
        if doc and "qid" not in doc:
            return None
        totals = self._totals()
        counting = self.commits().filter(F.col("segment").between(totals.base, totals.last))
        bare = counting.filter(F.col("filtered").isNull()).select("segment")
        filters = self._stored("members", FILTER, totals)
        held = may_hold(filters, written.select("id"), "id").select("segment")
        if doc:
            held = held.union(may_hold(filters, written.select("qid"), "qid").select("segment"))
        return sorted(r["segment"] for r in bare.union(held).distinct().collect())

    def _replaced(self, written: DataFrame, replace_by: Sequence[str] | None, within: Sequence[int] | None = None) -> DataFrame:
        """Ids of live points that the written ones replace; vectors are not read."""
        doc = list(replace_by or ())
        live = self._live(["id", *doc], within).drop("segment")
        gone = live.join(written.select("id"), "id", "left_semi").select("id")
        if doc:
            documents = written.select(*doc).distinct()
            gone = gone.union(narrow_join(live, documents, doc, ["id"], "left_semi").select("id")).distinct()
        return gone

    def ensure_ready(self) -> None:
        if not self.exists():
            raise ValueError(f"collection {self.name} does not exist; call ensure() first")

    def _checked_vector(self, vector: Column) -> Column:
        size = self.describe().vector_size
        message = F.concat(F.lit(f"vector size must be {size}, got "), F.coalesce(F.size(vector), F.lit(-1)).cast("string"))
        wrong = vector.isNull() | (F.size(vector) != size)
        return F.when(wrong, F.raise_error(message).cast("array<float>")).otherwise(vector)

    def compact(self) -> None:
        """Rewrite the current points as one segment, so that readers have nothing to leave out."""
        totals = self._totals()
        segment = totals.last + 1
        data = self._data(segment)
        self._live(POINTS.fieldNames()).drop("segment").write.mode("overwrite").parquet(data)
        written = self.spark.read.schema(POINTS).parquet(data)
        n_points = written.count()
        self._write_words(written, segment, n_points)
        self._write_members(written, segment, n_points)
        # The commit moves the base; until then readers see the former segments.
        self._commit(segment, segment, n_points, 0)
        for name in ("data", "removed", "text", "words", "members"):
            for old in range(totals.base, segment):
                drop_path(self.spark, f"{self.root}/{name}/segment={old}")


def added_points(before: int | None, after: int | None) -> int | None:
    """Points added by a run; None when a count is not available."""
    return None if before is None or after is None else after - before
