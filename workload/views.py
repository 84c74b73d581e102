"""Inputs of the queries, derived from the given tables with Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions import keys
from shelfmark.schemas import CRAN_PACKAGE, OTHER, PUBLICATION
from shelfmark.sources.graph import items_from_triples
from shelfmark.sources.objects import index_files, indexed

PREDICATE, SOFTWARE = "P31", "Q7397"
GRAPH = "Atlas"
GRAPH_TYPE = "ATLAS_KG_ITEM"


# Columns to spread a table by when it is a file of one piece.
SPREAD_BY = {"orders": "o_orderkey", "documents": "doc_id", "pages": "page_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. A single file is spread over the cores; a table of many files is read as it is split already."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if name in SPREAD_BY and len(df.inputFiles()) == 1:
        return df.repartition(spark.sparkContext.defaultParallelism, SPREAD_BY[name])
    return df


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    is_software = F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    return customer.select(
        F.concat(F.lit("https://kg.example/entity/Q"), _text("c_custkey")).alias("s"),
        F.lit(PREDICATE).alias("p"),
        F.when(is_software, SOFTWARE).otherwise("Q2").alias("o"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items_from_triples(triples(spark, sf_dir), PREDICATE, SOFTWARE)


def object_key() -> Column:
    """An object key per order; some lie outside any item, some have other extensions."""
    customer = F.lpad(_text("o_custkey"), 6, "0")
    folder = F.concat_ws("/", F.lit("main"), *[F.substring(customer, at, 2) for at in (1, 3, 5)])
    number = F.col("o_orderkey")
    suffix = F.element_at(F.array(*map(F.lit, (".pdf", ".PDF", ".html", ".csv"))), (number % 4 + 1).cast("int"))
    inside = F.concat(
        folder,
        F.lit("/Q"),
        _text("o_custkey"),
        F.lit("/components/pkg"),
        (number % 50).cast("string"),
        F.lit("_"),
        (number % 7).cast("string"),
        F.lit("."),
        number.cast("string"),
        suffix,
    )
    outside = F.concat(F.lit("main/other/order_"), number.cast("string"), F.lit(".txt"))
    return F.when(number % 10 == 0, outside).otherwise(inside)


def objects_of(orders: DataFrame) -> DataFrame:
    return orders.select(object_key().alias("key"))


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return objects_of(table(spark, sf_dir, "orders"))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One order, one key: the listing is distinct as it is.
    return indexed(index_files(objects(spark, sf_dir), distinct=False))


def status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status rows of the files tried so far: those of orders above low priority."""
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") != "5-LOW")
    state = (
        F.when(F.col("o_orderstatus") == "F", "ok")
        .when(F.col("o_orderstatus") == "P", "planned")
        .otherwise("failed - TimeoutError")
    )
    listed = orders.select(
        object_key().alias("component"), F.col("o_orderdate").cast("timestamp").alias("updated_at"), state.alias("status")
    )
    return indexed(
        listed.filter(keys.has_extension(F.col("component"))).select(
            keys.item_id(F.col("component")).alias("qid"), "component", "updated_at", "status"
        )
    )


def file_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file index with the order date as its time stamp."""
    listed = table(spark, sf_dir, "orders").select(
        object_key().alias("component"), F.col("o_orderdate").cast("timestamp").alias("updated_at")
    )
    return indexed(
        listed.filter(keys.has_extension(F.col("component"))).select(
            keys.item_id(F.col("component")).alias("qid"), "component", "updated_at"
        )
    )


def status_events(events: DataFrame) -> DataFrame:
    """Status rows out of the event stream; one user and event type is one file."""
    kind = F.element_at(
        F.array(F.lit("ok"), F.lit("planned"), F.lit("failed - TimeoutError")), (F.col("event_id") % 3 + 1).cast("int")
    )
    return events.select(
        F.concat(F.lit("Q"), _text("user_id")).alias("qid"),
        F.col("event_type").alias("component"),
        F.col("ts").cast("timestamp").alias("updated_at"),
        kind.alias("status"),
    )


def conversation_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of several pages: a conversation with a page per turn."""
    return table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("Q"), _text("conv_id")).alias("qid"),
        F.concat(F.lit("talk_"), _text("conv_id"), F.lit(".txt")).alias("component"),
        F.col("turn").cast("int").alias("page"),
        F.lit(None).cast("string").alias("title"),
        "text",
    )


def document_type() -> Column:
    kinds = F.array(*map(F.lit, (CRAN_PACKAGE, GRAPH_TYPE, PUBLICATION, OTHER)))
    return F.element_at(kinds, (F.col("doc_id") % 4 + 1).cast("int"))


def document_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of one long page."""
    number = _text("doc_id")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat(F.lit("Q"), number).alias("qid"),
        F.concat(F.lit("docs/"), F.col("source"), F.lit("_1."), number, F.lit(".txt")).alias("component"),
        F.lit(0).alias("page"),
        F.concat(F.col("lang"), F.lit(": document "), number).alias("title"),
        "text",
        document_type().alias("document_type"),
    )


def user_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    return turns.select(
        F.concat_ws("-", _text("conv_id"), _text("turn")).alias("query_id"), "text"
    )
