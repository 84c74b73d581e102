"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, split as its files are."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Rows of an Arrow batch that are Python objects at a time.
_SLICE = 256


def values(column: pa.Array) -> Iterator:
    """The values of a column, one after the other; a batch of long texts is never there twice."""
    for at in range(0, len(column), _SLICE):
        yield from column.slice(at, _SLICE).to_pylist()


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    for at in range(0, len(batch), _SLICE):
        yield from batch.slice(at, _SLICE).to_pylist()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts side by side, and where each begins (one more than texts); null counts as empty."""
    filled = pc.fill_null(column.cast(pa.large_string()), "")
    _, ends, data = filled.buffers()
    edges = np.frombuffer(ends, dtype=np.int64)[filled.offset : filled.offset + len(filled) + 1]
    if not len(filled) or data is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(filled) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[edges[0] : edges[-1]], edges - edges[0]


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it (case does not count)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def keep_rows(docs: DataFrame, id_col: str, key: str, verdict: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``verdict`` keeps, with the columns of ``docs`` without ``key``.

    ``verdict`` has one row (doc_id, key, kept) per row of ``docs``. Rows are
    known by id and key. Where several rows share both and only one of them is
    kept, any one of them stays. Spark chooses between broadcast and shuffle by
    the measured size of the list of dropped rows.
    """
    pairs = verdict.groupBy("doc_id", "key").agg(
        F.max("kept").alias("_any"), F.count("*").alias("_n"), F.count_if("kept").alias("_stay")
    )
    gone = pairs.filter(~F.col("_any")).select(F.col("doc_id").alias("_gone_id"), F.col("key").alias("_gone_key"))
    same = F.col(id_col).eqNullSafe(F.col("_gone_id")) & F.col(key).eqNullSafe(F.col("_gone_key"))
    kept = docs.join(gone, same, "left_anti")
    thinned = pairs.filter(F.col("_any") & (F.col("_stay") < F.col("_n"))).select(
        F.col("doc_id").alias("_gone_id"), F.col("key").alias("_gone_key")
    )
    if thinned.isEmpty():
        return kept.drop(key)
    single = kept.join(thinned, same, "left_semi").dropDuplicates([id_col, key])
    return kept.join(thinned, same, "left_anti").unionByName(single).drop(key)
