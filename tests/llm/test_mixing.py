from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import mixing as m

SCHEMA = "doc_id long, source string, text string"


@pytest.mark.parametrize("weights", [[1], [1, 1], [5, 3, 1], [0.5] + [0.01] * 50, [1e-9, 1], [7] * 9])
def test_period_deviates_by_less_than_a_block(weights):
    shares = m.whole_shares(np.array(weights, dtype=float), 1024)
    assert shares.sum() == 1024 and (shares > 0).all()
    table = m.pfair_period(shares)
    counts = np.cumsum(table[:, None] == np.arange(len(shares)), axis=0)
    due = np.arange(1, 1025)[:, None] * shares / 1024
    assert (np.abs(counts - due) < 1).all()


def lags(phases, weights, blocks):
    """Simulates the phases slot by slot; checks shares, deviation and that every block has its place."""
    source = np.repeat(np.arange(len(blocks)), blocks)
    block = np.concatenate([np.arange(b) for b in blocks])
    slots = m.block_slots(phases, source, block)
    assert sorted(slots.tolist()) == list(range(int(sum(blocks))))
    order = source[np.argsort(slots)]
    ends = [p.slot for p in phases[1:]] + [len(order)]
    for phase, end in zip(phases, ends, strict=True):
        part = order[phase.slot : end]
        counts = np.cumsum(part[:, None] == np.arange(len(blocks)), axis=0)
        due = np.arange(1, len(part) + 1)[:, None] * phase.shares / phase.shares.sum()
        assert (np.abs(counts - due) < 1).all()
        live = np.flatnonzero(phase.shares)
        ideal = np.array(weights)[live] / np.array(weights)[live].sum()
        assert np.abs(phase.shares[live] / phase.shares.sum() - ideal).max() <= len(live) / phase.shares.sum()


@pytest.mark.parametrize(
    ("weights", "blocks"),
    [([1, 1], [5, 5]), ([3, 1], [5000, 10]), ([1, 2, 4], [1, 3000, 2500]), ([1], [2049]), ([5, 1, 1], [7, 4000, 1]), ([1, 1], [1024, 1])],
)
def test_phases(weights, blocks):
    lags(m.pfair_phases(np.array(weights, dtype=float), np.array(blocks)), weights, blocks)


def test_every_row_has_one_place(spark):
    rows = [(i, "big" if i % 3 else "small", "t") for i in range(300)]
    rows += [(5, "big", "t"), (5, "big", "u"), (None, None, None), (None, None, None), (7, None, ""), (8, "", "x")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = m.mix(df, block=4).collect()
    assert sorted(r.position for r in got) == list(range(len(rows)))
    assert Counter((r.doc_id, r.source) for r in got) == Counter((i, s) for i, s, _ in rows)
    by_source = defaultdict(list)
    for r in sorted(got, key=lambda r: r.position):
        assert r.block == r.source_rank // 4
        by_source[r.source].append(r.source_rank)
    assert all(ranks == list(range(len(ranks))) for ranks in by_source.values())
    slots = sorted({(r.slot, r.source, r.block) for r in got})
    assert [s for s, *_ in slots] == list(range(len(slots)))


def test_mixed_keeps_rows_and_columns_in_order(spark):
    rows = [(i % 40, f"s{i % 3}", f"t{i}") for i in range(90)] + [(1, "s1", "t1")] * 2 + [(None, "s2", None)] * 2
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("text", "_position").repartition(3)
    got = m.mixed(df.withColumn("copy", F.create_map("source", "doc_id")), {"s0": 2, "s1": 1, "s2": 1, None: 1}, block=2)
    assert got.columns == [*df.columns, "copy"]
    listed = [tuple(r)[:3] for r in got.collect()]
    assert Counter(listed) == Counter(map(tuple, rows))
    shares = Counter(s for _, s, _ in listed[:40])
    assert abs(shares["s0"] - 16) <= 2 * 2 + 2 and shares["s1"] >= 6


def test_empty_table_and_missing_weight(spark):
    assert m.mix(spark.createDataFrame([], SCHEMA)).collect() == []
    assert m.mixed(spark.createDataFrame([], SCHEMA)).collect() == []
    with pytest.raises(ValueError, match="positive weight"):
        m.mix(spark.createDataFrame([(1, "a", "")], SCHEMA), {"b": 1.0})
