"""Item lists from knowledge-graph triples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.arrays import unnest
from shelfmark.schemas import BINDINGS


def local_name(iri: Column) -> Column:
    return F.regexp_replace(iri, r"^.*/", "")


def items_from_triples(triples: DataFrame, predicate: str, value: str, *, ordered: bool = False) -> DataFrame:
    """Local names of the subjects of matching triples: ``qid``."""
    found = triples.filter((F.col("p") == predicate) & (F.col("o") == value)).select(
        local_name(F.col("s")).alias("qid")
    )
    return found.orderBy("qid") if ordered else found


def items_from_bindings(bodies: DataFrame, column: str = "body") -> DataFrame:
    """Item ids out of ``{"results": {"bindings": [{"qid": {"value": …}}]}}`` bodies.

    A body without bindings, or one that is not JSON, gives no rows.
    """
    parsed = bodies.select(F.from_json(F.col(column), BINDINGS).alias("data"))
    return unnest(parsed, F.col("data.results.bindings"), "b").select(F.col("b.qid.value").alias("qid"))
