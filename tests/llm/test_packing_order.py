import random
from collections import Counter

import corpus_pipeline as c
from tests.llm.test_packing import check

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def shares(out, source):
    """Share of each source in the tokens of each third of the sequences."""
    rows = out.collect()
    last = max(r.sequence_id for r in rows) + 1
    counts = [Counter() for _ in range(3)]
    for r in rows:
        counts[r.sequence_id * 3 // last][source[r.doc_id]] += r.length
    return [{s: n / x.total() for s, n in x.items()} for x in counts]


def test_sequences_follow_the_mix(spark, tmp_path):
    rng = random.Random(1)
    text = lambda: " ".join(rng.choice(("house", "tree", "river")) for _ in range(rng.randint(30, 900)))
    names = ["a"] * 1280 + ["b"] * 320 + ["c"] * 320
    rows = [(i, text(), "en", s, 0) for i, s in enumerate(names)]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    c.mixing_stage(spark, docs, "").write.parquet(f"{tmp_path}/mixed")
    mixed = spark.read.parquet(f"{tmp_path}/mixed")
    out = c.packing_stage(spark, mixed, "")
    check([(i, t) for i, t, *_ in rows], out)
    # Weights are 1280, 320 and 320 to the power 0.7: 0.57 and twice 0.216.
    total = 1280**0.7 + 2 * 320**0.7
    parts = shares(out, names)
    for s, n in (("a", 1280), ("b", 320), ("c", 320)):
        assert abs(parts[0][s] - n**0.7 / total) < 0.06
    # The same rows in another order give other sequences.
    mixed.coalesce(1).sort("doc_id").write.parquet(f"{tmp_path}/sorted")
    other = c.packing_stage(spark, spark.read.parquet(f"{tmp_path}/sorted"), "")
    assert shares(other, names)[0]["a"] > 0.9
    placed = lambda df: {(r.doc_id, r.start): r.sequence_id for r in df.collect()}
    assert placed(out) != placed(other)
