"""Retrieval and prompts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.context import CONTEXT_TEXTS, DEFAULT_TEMPLATE, contexts, prompts
from shelfmark.operators.embedding import Embedder, embed_column
from shelfmark.operators.knn import top_k, with_payload
from shelfmark.operators.points import split_payload


def retrieve(
    points: DataFrame,
    queries: DataFrame,
    embedder: Embedder,
    k: int = 30,
    metric: str = "COSINE",
    *,
    with_vectors: bool = False,
) -> DataFrame:
    """The ``k`` best points for every ``(query_id, text)`` row.

    ``query_id, rank, score, id, page_content, metadata``; ``with_vectors``
    adds the vectors and keeps the whole payload as metadata.
    """
    asked = queries.select("query_id", embed_column(F.col("text"), embedder).alias("vector"))
    found = top_k(points, asked, k, metric)
    columns = ["id", "payload", *(["vector"] if with_vectors else [])]
    hits = with_payload(found, points.select(*columns))
    content, rest = split_payload(F.col("payload"))
    metadata = F.col("payload") if with_vectors else rest
    return hits.select(
        "query_id",
        "rank",
        "score",
        "id",
        content.alias("page_content"),
        metadata.alias("metadata"),
        *(["vector"] if with_vectors else []),
    )


def retrieve_prompts(
    points: DataFrame,
    queries: DataFrame,
    embedder: Embedder,
    k: int = 5,
    n: int = CONTEXT_TEXTS,
    metric: str = "COSINE",
    template: str = DEFAULT_TEMPLATE,
) -> DataFrame:
    """One prompt per query, its context made of the ``n`` best texts."""
    context = contexts(retrieve(points, queries, embedder, k, metric), n)
    questions = queries.select("query_id", F.col("text").alias("question"))
    return prompts(questions, context, template)
