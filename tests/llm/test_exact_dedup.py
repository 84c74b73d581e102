import hashlib
from collections import Counter, defaultdict

import numpy as np

from shelfmark.llm.exact_dedup import deduplicated, exact_dedup, merged_filter, partition_filters

LONG = "lorem " * 50_000


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").encode().lower()].append(i)
    out = []
    for text, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        kept = False
        for i in ids:
            stays = i == best and not kept
            kept |= stays
            out.append((i, best, len(ids), stays, hashlib.sha256(text).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_edge_cases(docs):
    rows = [(1, "A b"), (5, "a B"), (5, "a b"), (None, "a b"), (2, None), (3, ""), (4, "Ä"), (6, "ä"), (7, LONG)]
    rows += [(8, LONG.upper()), (None, "only null"), (None, "ONLY null"), (9, "a b "), (9, "other text, same id")]
    assert found(exact_dedup(docs(rows))) == expected(rows)
    kept = [(r.doc_id, (r.text or "").encode().lower()) for r in deduplicated(docs(rows)).collect()]
    wanted = [(i, best) for i, best, *_ in expected(rows)]
    assert len(kept) == len({t for _, t in kept}) == len({(t or "").encode().lower() for _, t in rows})
    assert Counter(i for i, _ in kept) == Counter(i for i, b, _, k, _ in expected(rows) if k) and wanted


def test_given_documents(given):
    rows = [(r.doc_id, r.text) for r in given.collect()]
    assert found(exact_dedup(given)) == expected(rows)


def test_empty_table_and_clashing_columns(spark, docs):
    assert exact_dedup(docs([])).collect() == [] and deduplicated(docs([])).collect() == []
    odd = spark.createDataFrame([(1, "x", True, "y"), (2, "X", False, "z")], "doc_id long, text string, kept boolean, _sha256 string")
    assert deduplicated(odd).columns == odd.columns
    assert [tuple(r) for r in deduplicated(odd).collect()] == [(2, "X", False, "z")]


def test_merged_filters_count_exactly(spark):
    rng = np.random.default_rng(3)
    prints = rng.integers(-(1 << 63), (1 << 63) - 1, 400)
    rows = [int(p) for p in np.concatenate([prints, prints[:100], prints[:10], prints[:10]])]
    # Neighbours that share the quotient, and the extremes.
    rows += [0, 1, 1, -1, -1, -(1 << 63), (1 << 63) - 1]
    for parts, bits in ((5, 16), (3, 20)):
        df = spark.createDataFrame([(r,) for r in rows], "fp long").repartition(parts)
        merged = {r.fp: r.n for r in merged_filter(partition_filters(df, bits), bits).collect()}
        assert merged == Counter(rows)
