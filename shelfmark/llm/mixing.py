"""Mixing sources to target weights by Pfair scheduling.

Every source is cut into blocks of documents. In a schedule with one slot per
block, block k of a source with share w is released at slot floor(k / w) and due
by ceil((k + 1) / w). Taking the earliest deadline among the released blocks
meets every deadline, so at any slot a source has had less than one block more
or less than its share. Shares are the given weights as exact fractions, however
long the schedule is. When a source has no blocks left, a new phase with the
shares of the others begins.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from fractions import Fraction
from itertools import count
from math import lcm

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import fresh, read
from shelfmark.operators.ordinals import with_ordinal
from shelfmark.session import stage

# Documents of a block.
BLOCK = 32
# Exponent of a source's number of documents in its default weight.
SMOOTHING = 0.7


def whole_shares(weights: np.ndarray, period: int) -> np.ndarray:
    """Blocks per period: at least one each, ``period`` in all, by largest remainders."""
    if len(weights) > period:
        raise ValueError("the period is shorter than the list of sources")
    spare = weights / weights.sum() * (period - len(weights))
    shares = np.floor(spare).astype(np.int64)
    rest = period - len(weights) - int(shares.sum())
    shares[np.argsort(shares - spare, kind="stable")[:rest]] += 1
    return shares + 1


def pfair_period(shares: np.ndarray) -> np.ndarray:
    """The source of every slot of one period: earliest deadline first among the released blocks."""
    period = int(shares.sum())
    released: list[list[tuple[int, int, int]]] = [[] for _ in range(period)]
    for s, share in enumerate(shares.tolist()):
        for k in range(share):
            deadline = -(-(k + 1) * period // share)
            released[k * period // share].append((deadline, s, k))
    ready: list[tuple[int, int, int]] = []
    out = np.zeros(period, dtype=np.int64)
    for slot in range(period):
        for job in released[slot]:
            heapq.heappush(ready, job)
        deadline, out[slot], _ = heapq.heappop(ready)
        assert deadline > slot
    return out


@dataclass(frozen=True)
class Phase:
    """From ``slot`` on, the sources with a share take turns; ``first`` is each one's first block."""

    slot: int
    first: np.ndarray
    shares: np.ndarray  # the weights of the sources that have blocks left, 0 for the others
    places: list[np.ndarray]  # per source the slots of its blocks of this phase, in order


def _whole(weights: np.ndarray) -> list[int]:
    """The weights times a common factor that makes whole numbers of them; nothing is rounded."""
    fractions = [Fraction(w) for w in weights.tolist()]
    factor = lcm(*[f.denominator for f in fractions])
    return [int(f * factor) for f in fractions]


def pfair_phases(weights: np.ndarray, blocks: np.ndarray) -> list[Phase]:
    """The schedule of all blocks, in phases that end when a source runs out."""
    whole = _whole(weights)
    left, done, slot = blocks.astype(np.int64).tolist(), np.zeros(len(blocks), dtype=np.int64), 0
    phases: list[Phase] = []
    live = [s for s, n in enumerate(left) if n > 0]
    while live:
        total = sum(whole[s] for s in live)
        places: dict[int, list[int]] = {s: [] for s in live}
        # The next block of every source waits for its release, or is ready and due by its deadline.
        waiting: list[tuple[int, int]] = []
        ready = [(-(-total // whole[s]), s) for s in live]
        heapq.heapify(ready)
        for turn in count():
            while waiting and waiting[0][0] <= turn:
                s = heapq.heappop(waiting)[1]
                heapq.heappush(ready, (-(-(len(places[s]) + 1) * total // whole[s]), s))
            deadline, s = heapq.heappop(ready)
            assert deadline > turn
            places[s].append(slot + turn)
            if len(places[s]) == left[s]:
                break
            heapq.heappush(waiting, (len(places[s]) * total // whole[s], s))
        shares = np.zeros(len(blocks))
        shares[live] = weights[live]
        phases.append(Phase(slot, done.copy(), shares, [np.array(places.get(i, []), np.int64) for i in range(len(blocks))]))
        for i in live:
            left[i] -= len(places[i])
            done[i] += len(places[i])
        live, slot = [i for i in live if left[i]], slot + turn + 1
    return phases


def block_slots(phases: list[Phase], source: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The slot of each (source, block)."""
    out = np.zeros(len(block), dtype=np.int64)
    for s in np.unique(source):
        mine = source == s
        out[mine] = np.concatenate([p.places[s] for p in phases])[block[mine]]
    return out


def mix(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    id_col: str = "doc_id",
    source_col: str = "source",
    block: int = BLOCK,
) -> DataFrame:
    """A row per document: (doc_id, source, source_rank, block, slot, position).

    ``weights`` names a positive weight for every source; by default it is the
    number of documents to the power 0.7, which lifts small sources. A null
    source is a source of its own. ``position`` runs from 0 without gaps; in
    it, a source's blocks deviate from its share by less than one block since
    the start of the phase, and a new phase begins when a source runs out.
    Every document has its place exactly once; repeated rows and null ids have
    one each. Within a source the order is that of a hash of the id. An empty
    table gives an empty result. The driver works out the schedule, eight bytes
    per block of documents, and every executor has a copy.
    """
    narrow = stage(
        docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(source_col).cast("string").alias("source"))
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("shuffled", F.xxhash64("doc_id")),
        "sources",
    )
    # Nulls come first in the order below.
    counted = sorted(
        ((r["source"], r["n"]) for r in narrow.groupBy("source").agg(F.count("*").alias("n")).collect()),
        key=lambda x: (x[0] is not None, (x[0] or "").encode()),
    )
    names, sizes = [s for s, _ in counted], np.array([n for _, n in counted], dtype=np.int64)
    if weights is not None and any(not weights.get(s, 0) > 0 for s in names):
        raise ValueError("every source needs a positive weight")
    target = np.array([weights[s] for s in names], dtype=float) if weights is not None else sizes**SMOOTHING
    blocks = -(-sizes // block)
    phases = pfair_phases(target, blocks)
    # Slots of all blocks, source after source.
    schedule = np.concatenate([np.zeros(0, np.int64), *[p.places[i] for i in range(len(names)) for p in phases]])
    first_block = np.r_[0, np.cumsum(blocks)]
    starts = np.r_[0, np.cumsum(sizes)]
    # A source's last block may be short; later positions move up by what it lacks.
    ends = schedule[first_block[1:] - 1] if len(sizes) else schedule
    # Eight bytes per block: sent to each executor once.
    sent = docs.sparkSession.sparkContext.broadcast(schedule)
    by_end = np.argsort(ends)
    lacks = np.r_[0, np.cumsum((blocks * block - sizes)[by_end])]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {s: i for i, s in enumerate(names)}
        for batch in batches:
            coded = batch.column("source").dictionary_encode(null_encoding="encode")
            codes = np.array([number[s] for s in coded.dictionary.to_pylist()], dtype=np.int64)
            source = codes[coded.indices.to_numpy()] if len(codes) else np.zeros(0, dtype=np.int64)
            rank = batch.column("ordinal").to_numpy() - starts[source]
            slot = sent.value[first_block[source] + rank // block]
            position = slot * block + rank % block - lacks[np.searchsorted(ends[by_end], slot)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("source"), *map(pa.array, (rank, rank // block, slot, position))],
                names=["doc_id", "source", "source_rank", "block", "slot", "position"],
            )

    ranked = with_ordinal(narrow, ["source", "shuffled", "doc_id", "row"])
    schema = "doc_id long, source string, source_rank long, block long, slot long, position long"
    return ranked.select("doc_id", "source", "ordinal").mapInArrow(place, schema)


def mixed(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    id_col: str = "doc_id",
    source_col: str = "source",
    block: int = BLOCK,
) -> DataFrame:
    """``docs`` in the order of the mix: range-partitioned and sorted by position, columns unchanged."""
    at, copy = fresh(docs, "_position"), fresh(docs, "_copy")
    places = mix(docs, weights, id_col, source_col, block)
    by_id = Window.partitionBy("doc_id", "source").orderBy("position")
    places = stage(places.select("doc_id", "source", "position", F.row_number().over(by_id).alias("copy")), "places")
    source = F.col(source_col).cast("string")
    # Rows that agree on both are numbered in an order that a second run repeats. Maps have no hash.
    hashed = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
    same = Window.partitionBy(F.col(id_col), source).orderBy(F.xxhash64(*hashed))
    numbered = docs.withColumn(copy, F.row_number().over(same))
    i, s, c = (fresh(numbered, name) for name in ("_i", "_s", "_c"))
    renamed = places.toDF(i, s, at, c)
    on = F.col(id_col).cast("bigint").eqNullSafe(F.col(i)) & source.eqNullSafe(F.col(s)) & (F.col(copy) == F.col(c))
    joined = numbered.join(renamed, on).select(*[F.col(f"`{c}`") for c in docs.columns], at)
    return joined.sort(at).drop(at)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents"))
