"""Approximate top-k: random-hyperplane codes, exact scores where a code agrees.

The planes have components +1 and -1 taken from a hash, so that any engine can
work out the codes. The corpus stays in place: every task gets the queries and
their codes, works out the codes of its own rows and scores those that share
one with a query.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.vectors import resolve_metric
from shelfmark.operators import knn
from shelfmark.operators.knn import BestK, Part

# Corpus rows that a code should stand for, when the number of bits is left open.
ROWS_PER_CODE = 64


def planes(tables: int, bits: int, dim: int) -> np.ndarray:
    """Signs of plane ``bit`` of a table: +1 where md5('table:bit:dimension') begins with 8 or more."""
    names = (f"{t}:{b}:{d}" for t in range(tables) for b in range(bits) for d in range(dim))
    signs = [1.0 if int(hashlib.md5(n.encode()).hexdigest()[0], 16) >= 8 else -1.0 for n in names]
    return np.array(signs).reshape(tables * bits, dim)


def codes(vectors: np.ndarray, sides: np.ndarray, tables: int) -> np.ndarray:
    """``(rows, tables)``: the side of each plane of a table a vector is on, as bits."""
    bits = len(sides) // tables
    above = (vectors @ sides.T > 0).reshape(len(vectors), tables, bits)
    return (above * (np.int64(1) << np.arange(bits, dtype=np.int64))).sum(axis=2)


def approximate_top_k(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = 30,
    metric: str = "COSINE",
    *,
    dim: int,
    bits: int | None = None,
    tables: int = 8,
    id_col: str = "id",
    query_col: str = "query_id",
    vector_col: str = "vector",
    block: int = knn.MAX_SHARED_QUERIES,
) -> DataFrame:
    """``query_col, id_col, score, rank`` among the corpus rows that share the code of some table with the query.

    Recall grows with ``tables`` and falls with ``bits``, which follow from the
    number of corpus rows unless given; the scores are exact. Up to ``block``
    queries are sent to all tasks; more of them meet the rows by code.
    """
    if tables < 1 or (bits is not None and not 1 <= bits <= 62):
        raise ValueError("bits must be within 1..62 and tables positive")
    metric = resolve_metric(metric)
    corpus, queries = corpus.select(id_col, vector_col), queries.select(query_col, vector_col)
    schema = knn._hit_schema(corpus, queries, id_col, query_col)
    arrow_schema = knn._arrow_schema(schema)
    if bits is None:
        bits = min(62, max(1, math.ceil(math.log2(max(2, corpus.count() / ROWS_PER_CODE)))))
    sides = planes(tables, bits, dim)

    def search(asked: pa.Table) -> DataFrame:
        ids, vectors = knn._labels(asked.column(0)), knn._matrix(asked.column(1))
        sent = corpus.sparkSession.sparkContext.broadcast((ids, vectors, codes(vectors, sides, tables)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            query_ids, query_vectors, asked_codes = sent.value
            best = BestK(query_vectors, k, metric)
            # Queries by (table, code), so that a row meets only those it shares a code with.
            held: list[dict[int, np.ndarray]] = [_by_code(asked_codes[:, t]) for t in range(tables)]
            for batch in batches:
                row_ids, rows = knn._labels(batch.column(0)), knn._matrix(batch.column(1))
                if len(row_ids):
                    query, row = _matches(codes(rows, sides, tables), held, len(query_ids))
                    best.add_pairs(Part(row_ids, rows, metric), query, row)
            query, found, scores = best.result()
            yield from knn._hit_batches([(query_ids[query], found, scores)], arrow_schema)

        return corpus.mapInArrow(run, schema)

    first = queries.limit(block + 1).toArrow()
    if first.num_rows == 0:
        return corpus.sparkSession.createDataFrame([], schema).withColumn("rank", F.lit(0))
    if first.num_rows <= block and first.nbytes <= knn.MAX_SHARED_BYTES:
        return knn.keep_best(search(first), k, metric, id_col, query_col)
    return knn.keep_best(_by_bucket(corpus, queries, k, metric, sides, tables, schema), k, metric, id_col, query_col)


def _by_bucket(
    corpus: DataFrame, queries: DataFrame, k: int, metric: str, sides: np.ndarray, tables: int, schema: T.StructType
) -> DataFrame:
    """Rows and queries meet by (table, code), so each is moved once per table, whatever their number.

    A bucket is scored by matrix products. A pair that agrees on several
    tables counts in the first of them. Large buckets are held in pieces, and
    have copies for groups of queries.
    """
    query_col, id_col = schema.names[:2]
    id_kind, query_kind = schema[id_col].dataType, schema[query_col].dataType
    arrow_schema = knn._arrow_schema(schema)
    float_only = {corpus.dtypes[1][1], queries.dtypes[1][1]} == {"array<float>"}
    vector_kind = "array<float>" if float_only else "array<double>"

    def coded(rows: DataFrame) -> DataFrame:
        """``key, vector, codes, table, code``: a row per table."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    found = codes(knn._matrix(batch.column(1)), sides, tables)
                    ends = pa.array(np.arange(0, found.size + 1, tables, dtype=np.int32))
                    lists = pa.ListArray.from_arrays(ends, pa.array(found.ravel()))
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["key", "vector", "codes"])

        named = rows.toDF("key", "vector").withColumn("vector", F.col("vector").cast(vector_kind))
        kind = named.schema["key"].dataType.simpleString()
        made = named.mapInArrow(run, f"key {kind}, vector {vector_kind}, codes array<bigint>")
        return made.select("*", F.posexplode_outer("codes").alias("table", "code"))

    on = ["table", "code"]
    most = max(1, min(knn.PIECE_ROWS, knn.PIECE_BYTES // (8 * max(1, sides.shape[1]))))

    def parts(rows: DataFrame, most: int, name: str) -> DataFrame:
        """Buckets with more than ``most`` rows, and the parts they come in."""
        return rows.groupBy(*on).agg(F.ceil(F.count("*") / F.lit(most)).cast("int").alias(name)).filter(F.col(name) > 1)

    left, right = coded(corpus), coded(queries)
    pieces, groups = parts(left, most, "pieces"), parts(right, knn.GROUP_QUERIES, "groups")
    cut = pieces.join(groups, on, "full").cache()
    one = lambda name: F.coalesce(F.col(name), F.lit(1))
    all_of = lambda name: F.explode(F.sequence(F.lit(0), one(name) - 1))
    mine = lambda name: F.pmod(F.xxhash64("key"), one(name)).cast("int")
    held = left.join(F.broadcast(cut), on, "left").select(
        *on, mine("pieces").alias("piece"), all_of("groups").alias("group"), F.lit(0).alias("kind"),
        F.col("key").alias("id"), F.lit(None).cast(query_kind).alias("query"), "vector", "codes",
    )
    asked = right.join(F.broadcast(cut), on, "left").select(
        *on, all_of("pieces").alias("piece"), mine("groups").alias("group"), F.lit(1).alias("kind"),
        F.lit(None).cast(id_kind).alias("id"), F.col("key").alias("query"), "vector", "codes",
    )
    key = [*on, "piece", "group"]
    together = held.unionByName(asked).repartition(*key).sortWithinPartitions(*key, "kind")

    def listed(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        return knn._matrix(batch.column(7)), batch.column(8).flatten().to_numpy().reshape(-1, tables)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts, held = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy() for i in range(5)], axis=1)
            edges = np.r_[0, np.nonzero((keys[1:] != keys[:-1]).any(axis=1))[0] + 1, len(keys)]
            for start, stop in zip(edges[:-1], edges[1:]):
                part, at = batch.slice(start, stop - start), tuple(keys[start])
                if at[:4] != current:
                    current, parts, held = at[:4], [], None
                if at[4] == 0:
                    parts.append((knn._labels(part.column(5)), *listed(part)))
                    continue
                if not parts and held is None:
                    continue
                if held is None:
                    ids, rows, row_codes = map(np.concatenate, zip(*parts))
                    steps = [slice(i, i + knn._ROW_STEP) for i in range(0, len(ids), knn._ROW_STEP)]
                    held, parts = [(Part(ids[s], rows[s], metric), row_codes[s, : at[0]]) for s in steps], []
                for first in range(0, part.num_rows, knn._QUERY_STEP):
                    some = part.slice(first, knn._QUERY_STEP)
                    vectors, query_codes = listed(some)
                    best = BestK(vectors, k, metric)
                    for rows, before in held:
                        # In an earlier table the two have met already.
                        best.add(rows, None, lambda q, r: (query_codes[q, : at[0]] != before[r]).all(axis=1))
                    query, found, scores = best.result()
                    yield from knn._hit_batches([(knn._labels(some.column(6))[query], found, scores)], arrow_schema)

    return together.mapInArrow(meet, schema)


def _by_code(column: np.ndarray) -> dict[int, np.ndarray]:
    order = np.argsort(column, kind="stable")
    edges = np.flatnonzero(np.r_[True, column[order][1:] != column[order][:-1]])
    return {int(column[part[0]]): part for part in np.split(order, edges[1:])} if len(column) else {}


def _matches(rows: np.ndarray, held: list[dict[int, np.ndarray]], n_queries: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row) that agree on the code of some table, each once."""
    found = []
    for t, by_code in enumerate(held):
        for code, part in _by_code(rows[:, t]).items():
            asked = by_code.get(code)
            if asked is not None:
                found.append((np.repeat(part, len(asked)) * n_queries + np.tile(asked, len(part))))
    pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.int64)
    return pairs % n_queries, pairs // n_queries
