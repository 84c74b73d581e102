"""Near-duplicate groups by SimHash, found through per-segment bit counts.

A 64-bit fingerprint is cut into 32 segments of two bits. The vector of their
bit counts is a point on a grid, and the Manhattan distance of two points never
exceeds the number of differing bits. Two points at distance 2 or less differ
in at most two of the blocks of segments, so they agree on all blocks of one of
the choices that leave two blocks out: a range join by equal grid cells. The
pairs of a cell are then compared bit by bit.

A crowded cell gives no pairs. Its fingerprints, and the 64 that are one bit
away from each, become meeting points: two fingerprints differ in two bits or
less exactly if they share a point, and each point links its members to the
smallest. That is exact and linear in the number of fingerprints.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.common import fresh, keep_rows, read, values
from shelfmark.llm.components import components
from shelfmark.session import Steps, stage

SHINGLE = 3
SEED = 42
MAX_BITS = 2
# Blocks of the 32 segments. More blocks make smaller cells and more rows per fingerprint.
BLOCKS = 4
# Fingerprints of a cell beyond which its links are found through meeting points.
CROWDED = 64
_STEP = 1 << 16


def simhash(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Fingerprint of one text. Bit j is set if over half the shingle hashes have it; no words give 0."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, and white space is 0x20 and 0x09 to 0x0D
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    k = min(shingle, len(words))
    starts = np.r_[0, ends[:-1] + 1][: len(words) - k + 1].tolist()
    hash_ = xxhash.xxh64_intdigest
    hashes = [hash_(joined[a:b], seed) for a, b in zip(starts, ends[k - 1 :].tolist(), strict=True)]
    count = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _STEP):
        part = np.array(hashes[at : at + _STEP], dtype="<u8").view(np.uint8).reshape(-1, 8)
        count += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(count * 2 > len(hashes), bitorder="little").view("<u8")[0])


@F.arrow_udf(T.LongType())
def fingerprint(texts: pa.Array) -> pa.Array:
    return pa.array(np.array([simhash(t) for t in values(texts)], dtype=np.uint64).view(np.int64))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _cells(prints: DataFrame, blocks: int) -> DataFrame:
    """(fp, choice, cell): a row for each choice of blocks that must agree."""
    even = F.lit(0x5555555555555555)
    # Bit counts of the 32 segments, two bits each, side by side in one number.
    low, high = F.col("fp").bitwiseAND(even), F.shiftrightunsigned("fp", 1).bitwiseAND(even)
    counts = low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))
    edges = [round(b * 32 / blocks) * 2 for b in range(blocks + 1)]
    masks = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges[:-1], edges[1:], strict=True)]
    chosen = [sum(masks[b] for b in c) for c in combinations(range(blocks), blocks - MAX_BITS)]
    keys = [
        F.struct(F.lit(i).alias("choice"), F.col("_c").bitwiseAND(F.lit(_signed(m))).alias("cell"))
        for i, m in enumerate(chosen)
    ]
    spread = prints.select("fp", counts.alias("_c")).select("fp", F.explode(F.array(*keys)).alias("_k"))
    return spread.select("fp", "_k.choice", "_k.cell")


def links(prints: DataFrame, steps: Steps, blocks: int = BLOCKS, crowded: int = CROWDED) -> DataFrame:
    """Links (u, v) whose components are those of all pairs that differ in two bits or less.

    ``prints`` holds distinct fingerprints ``fp``.
    """
    if blocks <= MAX_BITS:
        raise ValueError("more blocks are needed than bits may differ")
    cells = steps.stage(_cells(prints, blocks), "cells")
    sizes = steps.stage(cells.groupBy("choice", "cell").agg(F.count("*").alias("n")).filter("n > 1"), "cell-sizes")
    key = ["choice", "cell"]
    shared = cells.join(sizes.filter(F.col("n") <= crowded).drop("n"), key, "left_semi")
    a, b = shared.select(*key, F.col("fp").alias("u")), shared.select(*key, F.col("fp").alias("v"))
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= MAX_BITS
    same_cell = (a["choice"] == b["choice"]) & (a["cell"] == b["cell"])
    pairs = a.join(b, same_cell & (F.col("u") < F.col("v")) & near).select("u", "v")
    many = cells.join(sizes.filter(F.col("n") > crowded).drop("n"), key, "left_semi").select("fp").distinct()
    flips = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)])
    met = many.select(F.col("fp").alias("u"), F.explode(flips).alias("point"))
    least = met.groupBy("point").agg(F.min("u").alias("v"), F.count("*").alias("n")).filter("n > 1").drop("n")
    through = met.join(least, "point").filter("u <> v").select("u", "v")
    return pairs.union(through).distinct()


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", blocks: int = BLOCKS, crowded: int = CROWDED
) -> DataFrame:
    """A row per document: (doc_id, fp, component_id, kept).

    ``component_id`` is the smallest id that can be reached over links of two
    or fewer differing bits, the document's own included; null ids do not
    count, and a component of nulls only has null. ``kept`` is true for one row
    of each component: that id's, or any one of them where it is repeated.
    Null texts are empty; texts without words have fingerprint 0 and are linked
    like any other. An empty table gives an empty result.
    """
    narrow = stage(
        docs.select(F.col(id_col).cast("bigint").alias("doc_id"), fingerprint(F.col(text_col)).alias("fp")).withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "fingerprints",
    )
    steps = Steps()
    first = F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "row"))
    prints = steps.stage(narrow.groupBy("fp").agg(first.alias("first")), "distinct-fingerprints")
    roots = components(links(prints.select("fp"), steps, blocks, crowded), steps)
    rooted = prints.join(roots, prints["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first"
    )
    best = rooted.groupBy("root").agg(F.min("first").alias("best"))
    known = stage(rooted.select("fp", "root").join(best, "root").select("fp", "best"), "components")
    steps.release()
    return narrow.join(known, "fp").select(
        "doc_id", "fp", F.col("best.doc_id").alias("component_id"), (F.col("row") == F.col("best.row")).alias("kept")
    )


def near_deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component, columns unchanged."""
    key = fresh(docs, "_fp")
    verdict = simhash_groups(docs, id_col, text_col).select("doc_id", F.col("fp").alias("key"), "kept")
    return keep_rows(docs.withColumn(key, fingerprint(F.col(text_col))), id_col, key, stage(verdict, "kept"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_groups(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
