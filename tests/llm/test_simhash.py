import random
from collections import defaultdict

import pytest
import xxhash

from shelfmark.llm import simhash as s
from shelfmark.llm.components import components
from shelfmark.session import Steps


def brute_fingerprint(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    root = {p: p for p in prints}

    def top(p):
        while root[p] != p:
            p = root[p]
        return p

    prints = list(root)
    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= 2:
                root[top(a)] = top(b)
    return {p: top(p) for p in prints}


def expected(rows):
    prints = [(i, brute_fingerprint(t)) for i, t in rows]
    tops = brute_components([p for _, p in prints])
    members = defaultdict(list)
    for i, p in prints:
        members[tops[p]].append(i)
    least = {t: min((i for i in m if i is not None), default=None) for t, m in members.items()}
    return sorted(((i, s._signed(p), least[tops[p]]) for i, p in prints), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "fp", "component_id").collect()), key=repr)


def test_edge_cases(docs):
    rows = [(4, "one two three four"), (3, "One TWO three four"), (2, None), (9, ""), (None, " \t"), (7, "Ä ä"), (7, "Ä ä")]
    rows += [(8, "word"), (5, "a b"), (None, "x y z w"), (1, "a b c d e f"), (6, "long text " * 40_000)]
    df = docs(rows)
    assert found(s.simhash_groups(df)) == expected(rows)
    kept = s.near_deduplicated(df).collect()
    assert len(kept) == len({c if c is not None else -1 for *_, c in expected(rows)})


def test_empty_table_and_clashing_columns(spark, docs):
    assert s.simhash_groups(docs([])).collect() == [] and s.near_deduplicated(docs([])).collect() == []
    odd = spark.createDataFrame([(1, "x", 1, 2), (2, "X", 3, 4)], "doc_id long, text string, _fp long, row long")
    assert [tuple(r) for r in s.near_deduplicated(odd).collect()] == [(1, "x", 1, 2)]


def test_given_documents(given):
    rows = [(r.doc_id, r.text) for r in given.collect()]
    assert found(s.simhash_groups(given)) == expected(rows)


@pytest.mark.parametrize(("blocks", "crowded"), [(4, 64), (4, 2), (5, 3)])
def test_links_find_every_component(spark, blocks, crowded):
    rng = random.Random(blocks * 100 + crowded)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for p in list(prints)[:25]:
        for _ in range(6):
            q = p
            for _ in range(rng.randint(1, 5)):
                q ^= 1 << rng.randrange(64)
            prints.add(q)
    df = spark.createDataFrame([(s._signed(p),) for p in prints], "fp long")
    steps = Steps()
    roots = {r.node: r.root for r in components(s.links(df, steps, blocks, crowded), steps).collect()}
    steps.release()
    got, want = defaultdict(set), defaultdict(set)
    tops = brute_components(prints)
    for p in prints:
        got[roots.get(s._signed(p), s._signed(p))].add(p)
        want[tops[p]].add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(200, 300), (5, 5)], "u long, v long")
    steps = Steps()
    roots = {r.node: r.root for r in components(edges, steps).collect()}
    assert roots == {**dict.fromkeys(range(1, 21), 0), 300: 200}
