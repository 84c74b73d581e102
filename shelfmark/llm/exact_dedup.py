"""Exact duplicate removal through counting quotient filters.

Every partition puts the 64-bit fingerprints of its texts into a counting
quotient filter: the upper bits of a fingerprint (the quotient) name a slot,
the lower bits (the remainder) are kept sorted within the slot, with a count.
Filters of one geometry merge without loss, slot by slot, by merging sorted
remainders and adding counts. Only texts whose fingerprint has a count above
one are compared byte by byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.common import fresh, keep_rows, read, values
from shelfmark.session import stage

# Slots of one block. A block is what one merging task holds: as many fingerprints as slots, on average.
BLOCK_BITS = 16
_DIGEST = T.StructType([T.StructField("fp", T.LongType()), T.StructField("sha256", T.StringType())])


def normalise(text: str | None) -> bytes:
    """UTF-8 with A-Z in lower case and nothing else changed; null counts as empty."""
    return (text or "").encode().lower()


@F.arrow_udf(_DIGEST)
def digest(texts: pa.Array) -> pa.Array:
    found = [(xxhash.xxh3_64_intdigest(t), hashlib.sha256(t).hexdigest()) for t in map(normalise, values(texts))]
    prints = np.array([p for p, _ in found], dtype=np.uint64)
    return pa.StructArray.from_arrays(
        [pa.array(prints.view(np.int64)), pa.array([s for _, s in found], pa.string())], names=["fp", "sha256"]
    )


def normal_text(text: Column) -> Column:
    """The normalised text itself, without leaving the JVM."""
    return F.translate(F.coalesce(text, F.lit("")), ascii_uppercase, ascii_lowercase)


def _sorted_counts(quotient, remainder, count):
    """Slots in order, sorted remainders in each, equal ones joined with their counts added."""
    order = np.lexsort((remainder, quotient))
    quotient, remainder, count = quotient[order], remainder[order], count[order]
    first = np.ones(len(order), dtype=bool)
    first[1:] = (quotient[1:] != quotient[:-1]) | (remainder[1:] != remainder[:-1])
    at = np.flatnonzero(first)
    return quotient[at], remainder[at], np.add.reduceat(count, at) if len(at) else count


def partition_filters(prints: DataFrame, quotient_bits: int) -> DataFrame:
    """One counting quotient filter per partition, in blocks of slots: (block, slots, remainders, counts)."""
    low = np.uint64(64 - quotient_bits)
    block_bits = min(BLOCK_BITS, quotient_bits)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read_ = [b.column(0).to_numpy(zero_copy_only=False) for b in batches]
        if not read_:
            return
        fp = np.concatenate(read_).view(np.uint64)
        quotient = fp >> low
        remainder = fp & ((np.uint64(1) << low) - np.uint64(1))
        quotient, remainder, count = _sorted_counts(quotient, remainder, np.ones(len(fp), dtype=np.int64))
        block = (quotient >> np.uint64(block_bits)).astype(np.int64)
        slot = (quotient & np.uint64((1 << block_bits) - 1)).astype(np.uint16)
        edges = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True]) if len(block) else np.array([0])
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([block[lo]], pa.int64()),
                    "slots": [slot[lo:hi].tobytes()],
                    "remainders": [remainder[lo:hi].tobytes()],
                    "counts": [count[lo:hi].tobytes()],
                }
            )

    return prints.mapInArrow(build, "block long, slots binary, remainders binary, counts binary")


def merged_filter(filters: DataFrame, quotient_bits: int) -> DataFrame:
    """The filter of all partitions: (fp, n), by merging the sorted remainders block by block."""
    low = np.uint64(64 - quotient_bits)
    block_bits = min(BLOCK_BITS, quotient_bits)

    def merge(table: pa.Table) -> pa.Table:
        block = np.uint64(table.column("block")[0].as_py())
        parts = [
            np.frombuffer(b"".join(table.column(c).to_pylist()), dtype=kind)
            for c, kind in (("slots", np.uint16), ("remainders", np.uint64), ("counts", np.int64))
        ]
        slot, remainder, count = _sorted_counts(*parts)
        fp = (((block << np.uint64(block_bits)) | slot.astype(np.uint64)) << low) | remainder
        return pa.table({"fp": fp.view(np.int64), "n": count})

    return filters.groupBy("block").applyInArrow(merge, "fp long, n long")


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", quotient_bits: int | None = None
) -> DataFrame:
    """A verdict per row: (doc_id, keep_id, group_size, kept, text_sha256).

    Rows with equal normalised text form a group, and the row with the largest
    id stays. Null texts count as empty, and empty texts form a group like any
    other. A null id is smaller than all others. Of repeated rows (equal id and
    text) one stays. An empty table gives an empty result; other columns are
    not looked at. ``quotient_bits`` defaults to the binary logarithm of the
    number of rows.
    """
    found = digest(F.col(text_col))
    # The row number only breaks ties between repeated rows; it is written once and read from then on.
    narrow = stage(
        docs.select(F.col(id_col).cast("bigint").alias("doc_id"), found.alias("_d")).select(
            "doc_id", F.col("_d.fp").alias("fp"), F.col("_d.sha256").alias("text_sha256"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )
    rows = narrow.count()
    bits = quotient_bits or min(48, max(BLOCK_BITS, rows.bit_length()))
    prints = narrow.select("fp")
    several = stage(merged_filter(partition_filters(prints, bits), bits).filter("n > 1").select("fp"), "repeated")
    # Byte comparison: equal texts meet by their bytes, and each task sends one row for all copies that it has read.
    suspects = docs.select(digest(F.col(text_col)).alias("_d"), F.col(text_col).alias("_t"))
    suspects = suspects.select(F.col("_d.fp").alias("fp"), F.col("_d.sha256").alias("text_sha256"), "_t")
    suspects = suspects.join(several, "fp", "left_semi")
    verified = suspects.groupBy("text_sha256", normal_text(F.col("_t")).alias("_bytes")).agg(F.count("*").alias("n"))
    verified = stage(verified.filter("n > 1").select("text_sha256"), "verified")
    # Tasks sum up a group before it is shuffled, however many copies it has.
    groups = narrow.groupBy("text_sha256").agg(F.max(F.struct("doc_id", "row")).alias("best"), F.count("*").alias("size"))
    groups = groups.filter("size > 1").join(verified, "text_sha256", "left_semi")
    groups = groups.select(
        "text_sha256", F.col("best.doc_id").alias("best_id"), F.col("best.row").alias("best_row"), "size"
    )
    alone = F.col("size").isNull()
    return narrow.join(groups, "text_sha256", "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("best_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1).cast("bigint")).alias("group_size"),
        (alone | (F.col("row") == F.col("best_row"))).alias("kept"),
        "text_sha256",
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``exact_dedup`` drops, columns unchanged."""
    key = fresh(docs, "_sha256")
    verdict = exact_dedup(docs, id_col, text_col).select("doc_id", F.col("text_sha256").alias("key"), "kept")
    keyed = docs.withColumn(key, digest(F.col(text_col))["sha256"])
    return keep_rows(keyed, id_col, key, stage(verdict, "kept"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"))


# SHA-256 of the text with only A-Z lowered; equal texts by the text itself.
SQL = """
with d as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') t from documents
), g as (select t, max(doc_id) keep_id, count(*) group_size from d group by t)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(d.t) as text_sha256 from d join g on d.t = g.t
"""
