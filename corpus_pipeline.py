"""From raw documents to packed training sequences, in five stages.

Each stage gets the documents that the one before it kept, with the columns of
``documents``; the last returns the pieces of the packed sequences.

1. quality: documents that the quality classifier rejects go.
2. exact dedup: of equal texts, the document with the largest id stays.
3. SimHash near-dedup: of each component of linked fingerprints (three-word shingles, at most two differing bits),
   the document with the smallest id stays.
4. mixing: documents are put in an order in which every source keeps its share.
5. packing: documents are cut and packed into sequences, which follow the order of the fourth stage.

Null texts count as empty. Repeated rows are removed by the second stage. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import read
from shelfmark.llm.exact_dedup import deduplicated
from shelfmark.llm.mixing import mixed
from shelfmark.llm.packing import pack
from shelfmark.llm.quality import good_documents
from shelfmark.llm.simhash import near_deduplicated
from shelfmark.session import new_work_path, ship

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return good_documents(docs, read(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return deduplicated(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return near_deduplicated(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return mixed(docs)


def _listed(docs: DataFrame) -> list[Column]:
    """What the rows sort by as they are listed: part, file and row in it. Read splits may come in any order."""
    file, row = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    try:
        docs.select(file, row).schema  # noqa: B018
    except AnalysisException:  # not read from files
        return [F.monotonically_increasing_id()]
    return [F.regexp_extract(file, r"^part-(\d+)", 1).try_cast("bigint"), file, row]


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return pack(docs, order=_listed(docs))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_dedup_stage),
    ("SimHash near-dedup", simhash_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# The classifier, the fingerprints and the linear program are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_work_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
