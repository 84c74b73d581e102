"""Approximate search over stored vectors: points by cell, coded residuals, exact scores at the end.

Layout below one root:

    model/                       one row: the quantizer
    codes/cell=<c>/              blocks of ids and codes
    vectors/cell=<c>/            id, vector

``codes`` and ``vectors`` get further files with every ``add``.

A search reads the codes of the cells that its queries probe, keeps the best
candidates of each query and scores these on the vectors of the same cells.
Queries meet the blocks of a cell in a join on the cell, so any number of them
can be asked; neither side passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions import vectors as arithmetic
from shelfmark.functions.vectors import resolve_metric
from shelfmark.operators import cells as c
from shelfmark.operators.joins import narrow_join
from shelfmark.operators.knn import SCORE_DIGITS, _matrix, keep_best
from shelfmark.session import Steps, empty, path_exists

_MODEL = "metric string, cells int, dim int, parts int, words int, width int, probes int, id_type string, centres binary, books binary"
# Coded vectors of a block, and queries that meet a block together.
BLOCK = 1_024
PACK = 64
# Cells that a scan is told by name; with more, it reads all of them.
NAMED_CELLS = 2_000
# Candidates that are scored exactly, in multiples of k.
RERANK = 8
RECALL = 0.97


class VectorIndex:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self._known: tuple[c.Quantizer, str] | None = None

    def exists(self) -> bool:
        return path_exists(self.spark, f"{self.root}/model")

    def build(
        self, points: DataFrame, metric: str = "COSINE", cells: int | None = None, recall: float = RECALL, part: int = c.PART
    ) -> None:
        """Learn the cells from ``points`` (id, vector; ids unique, vectors of one size) and store all of them."""
        if self.exists():
            raise ValueError("the index is there already; use add()")
        metric = resolve_metric(metric)
        quantizer = c.learn(points, metric, recall, cells, part)
        kind = points.schema["id"].dataType.simpleString()
        if quantizer is None:
            raise ValueError("an index cannot be learned from no points")
        parts, words, width = quantizer.words.shape
        row = (
            metric, len(quantizer.centres), quantizer.dim, parts, words, width, quantizer.probes, kind,
            bytearray(quantizer.centres.astype("<f8").tobytes()), bytearray(quantizer.words.astype("<f8").tobytes()),
        )
        self._known = quantizer, kind
        self.add(points)
        # The model comes last: without it there is no index.
        self.spark.createDataFrame([row], _MODEL).coalesce(1).write.parquet(f"{self.root}/model")

    def quantizer(self) -> c.Quantizer:
        return self._model()[0]

    def _model(self) -> tuple[c.Quantizer, str]:
        if self._known is None:
            r = self.spark.read.schema(_MODEL).parquet(f"{self.root}/model").collect()[0]
            centres = np.frombuffer(r.centres, "<f8").reshape(r.cells, r.dim)
            words = np.frombuffer(r.books, "<f8").reshape(r.parts, r.words, r.width)
            self._known = c.Quantizer(r.metric, centres, words, r.probes), r.id_type
        return self._known

    def add(self, points: DataFrame) -> None:
        """Store further points; their ids must be new."""
        quantizer, kind = self._model()
        sent = self.spark.sparkContext.broadcast(quantizer)
        steps = Steps()

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            q = sent.value
            for whole in batches:
                for at in c.steps(len(whole)):
                    batch = whole.slice(at.start, c._STEP)
                    if not len(batch):
                        continue
                    ready = q.prepare(_matrix(batch.column("vector")))
                    cell = q.cells(ready)
                    code = [x.tobytes() for x in q.codes(ready, cell)]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id"), batch.column("vector"), pa.array(cell.astype(np.int32)), pa.array(code, pa.binary())],
                        names=["id", "vector", "cell", "code"],
                    )

        def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cell = batch.column("cell").to_numpy()
                edges = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]).tolist() + [len(cell)]
                for start, end in zip(edges, edges[1:], strict=False):
                    for at in range(start, end, BLOCK):
                        part = batch.slice(at, min(BLOCK, end - at))
                        ids = part.column("id")
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([cell[at]], pa.int32()),
                                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                                pa.array([b"".join(part.column("code").to_pylist())], pa.binary()),
                            ],
                            names=["cell", "ids", "codes"],
                        )

        vector = points.schema["vector"].dataType.simpleString()
        placed = points.select("id", "vector").mapInArrow(assign, f"id {kind}, vector {vector}, cell int, code binary")
        # A large cell is cut by id, so no writer gets all of it.
        placed = steps.stage(placed.repartitionByRange("cell", "id").sortWithinPartitions("cell", "id"), "placed")
        placed.select("id", "vector", "cell").repartitionByRange("cell", "id").sortWithinPartitions("cell", "id").write.mode(
            "append"
        ).partitionBy("cell").parquet(f"{self.root}/vectors")
        coded = placed.select("cell", "id", "code").mapInArrow(blocks, f"cell int, ids array<{kind}>, codes binary")
        coded.repartitionByRange("cell", "ids").write.mode("append").partitionBy("cell").parquet(f"{self.root}/codes")
        steps.release()

    def cells(self, table: str, cells: list[int] | None = None) -> DataFrame:
        """``codes`` or ``vectors``; of the named cells only, whose files alone are then read."""
        _, kind = self._model()
        schemas = {"codes": f"ids array<{kind}>, codes binary, cell int", "vectors": f"id {kind}, vector array<float>, cell int"}
        stored = self.spark.read.schema(schemas[table]).parquet(f"{self.root}/{table}")
        return stored if cells is None else stored.filter(F.col("cell").isin(cells))

    def search(
        self,
        queries: DataFrame,
        k: int = 30,
        probes: int | None = None,
        rerank: int = RERANK,
        without: DataFrame | None = None,
        query_col: str = "query_id",
    ) -> DataFrame:
        """``query_col, id, score, rank`` of about the ``k`` best points for every query (``query_col, vector``).

        ``probes`` cells are searched per query, by default as many as the
        index has measured. Of the candidates, ``rerank * k`` per query are
        scored exactly. Ids in ``without`` (id) are left out. Equal scores are
        ranked by id.
        """
        if k <= 0 or rerank <= 0 or (probes is not None and probes <= 0):
            raise ValueError("k, rerank and probes must be positive")
        quantizer, kind = self._model()
        metric, steps = quantizer.metric, Steps()
        query_kind = queries.schema[query_col].dataType.simpleString()
        out = f"{query_col} {query_kind}, id {kind}, score double, rank int"
        asked = steps.stage(queries.select(F.col(query_col).alias("query_id"), F.col("vector").cast("array<double>")), "asked")
        n = asked.count()
        if n == 0:
            return empty(self.spark, out)
        probed = steps.stage(self._probed(asked, n, query_kind, min(probes or quantizer.probes, len(quantizer.centres))), "probed")
        # At most as many rows as there are cells.
        named = [r["cell"] for r in probed.select("cell").distinct().limit(NAMED_CELLS + 1).collect()]
        cells = named if len(named) <= NAMED_CELLS else None
        blocks = self.cells("codes", cells)
        if without is not None:
            # Which cell a left-out id lies in is read from ids alone.
            gone = narrow_join(self.cells("vectors", cells).select("id", "cell"), without.select("id").distinct(), ["id"], ["cell"], "left_semi")
            blocks = blocks.join(gone.groupBy("cell").agg(F.collect_set("id").alias("gone")), "cell", "left")
        else:
            blocks = blocks.withColumn("gone", F.lit(None).cast(f"array<{kind}>"))
        sent = self.spark.sparkContext.broadcast(quantizer)
        most = rerank * k

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            q = sent.value
            for batch in batches:
                for row in range(len(batch)):
                    ids = batch.column("ids")[row].values
                    codes = np.frombuffer(batch.column("codes")[row].as_py(), dtype=np.uint8).reshape(len(ids), -1)
                    gone = batch.column("gone")[row]
                    if gone.is_valid and len(gone.values):
                        keep = np.array([i not in left_out for left_out in [set(gone.as_py())] for i in ids.to_pylist()], dtype=bool)
                        ids, codes = ids.filter(pa.array(keep)), codes[keep]
                    if not len(ids):
                        continue
                    asking = batch.column("asking")[row].values
                    cost = q.costs(q.prepare(_matrix(asking.field("vector"))), batch.column("cell")[row].as_py(), codes)
                    take = min(most, len(ids))
                    best = np.argpartition(cost, take - 1, axis=1)[:, :take]
                    who = np.repeat(np.arange(len(asking)), take)
                    yield pa.RecordBatch.from_arrays(
                        [
                            asking.field("query_id").take(pa.array(who)),
                            ids.take(pa.array(best.ravel())),
                            pa.array(np.take_along_axis(cost, best, axis=1).ravel()),
                            pa.array(np.full(len(who), batch.column("cell")[row].as_py(), dtype=np.int32)),
                        ],
                        names=["query_id", "id", "score", "cell"],
                    )

        found = blocks.join(probed, "cell").select("cell", "ids", "codes", "gone", "asking")
        rough = found.mapInArrow(score, f"query_id {query_kind}, id {kind}, score double, cell int")
        # A cost, smaller is better, whatever the metric.
        candidates = steps.stage(keep_best(rough, most, "EUCLID", "id", "query_id").drop("score", "rank"), "candidates")
        near = narrow_join(self.cells("vectors", cells), candidates, ["cell", "id"], ["id"])
        pairs = narrow_join(near, asked.withColumnRenamed("vector", "_asked"), ["query_id"], ["id"])
        exact = F.round(arithmetic.score(metric, F.col("vector"), F.col("_asked")), SCORE_DIGITS).alias("score")
        return keep_best(pairs.select("query_id", "id", exact), k, metric, "id", "query_id").withColumnRenamed("query_id", query_col)

    def _probed(self, asked: DataFrame, n: int, query_kind: str, probes: int) -> DataFrame:
        """(cell, asking): the queries that probe a cell, in packs of about ``PACK``."""
        sent = self.spark.sparkContext.broadcast(self.quantizer())

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            q = sent.value
            for batch in batches:
                if not len(batch):
                    continue
                found = q.probed(q.prepare(_matrix(batch.column("vector"))), probes)
                who = pa.array(np.repeat(np.arange(len(batch)), found.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("query_id").take(who), batch.column("vector").take(who), pa.array(found.ravel().astype(np.int32))],
                    names=["query_id", "vector", "cell"],
                )

        found = asked.mapInArrow(probe, f"query_id {query_kind}, vector array<double>, cell int")
        pack = F.pmod(F.xxhash64("query_id"), F.lit(-(-n // PACK)))
        return found.groupBy("cell", pack.alias("_pack")).agg(F.collect_list(F.struct("query_id", "vector")).alias("asking")).drop("_pack")


def measured_recall(found: DataFrame, exact: DataFrame, query_col: str = "query_id") -> float:
    """The share of exact hits (query, id) that were found."""
    keys = [query_col, "id"]
    both = exact.select(*keys).join(found.select(*keys), keys, "left_semi").count()
    return both / max(1, exact.count())
