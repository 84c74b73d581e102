import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shelfmark.llm import packing as p

WHOLE = Tokenizer.from_file(public_tokenizers.path(p.VOCABULARY))


def ids_of(text):
    return np.array(WHOLE.encode(text or "", add_special_tokens=False).ids + [p.END], dtype="<u4")


def check(rows, df, size=p.SEQUENCE):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in df.collect():
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for held in by_sequence.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at and length > 0
            at += length
        assert at <= size
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append(t)
    assert set(by_doc) == set(texts)
    for i, own in texts.items():
        wanted = sorted((s, len(x), zlib.crc32(x.tobytes()), len(a)) for a in map(ids_of, own) for s, x in
                        ((s, a[s : s + size]) for s in range(0, len(a), size)))
        assert sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in by_doc[i]) == wanted
    return {s: sum(n for _, n in held) for s, held in by_sequence.items()}


def test_edge_cases(docs):
    odd = "İstanbul ΣΑΣ don't we'll x's 12 3¼ á \x1c b\x85c naïve ﬁ !?... ß ÀÉ don 't 日本語 <|endoftext|>"
    rows = [(1, None), (2, ""), (3, odd), (3, odd), (None, "a b"), (None, "c"), (4, "word " * 30_000), (5, " \n\t "), (5, "x")]
    check(rows, p.pack(docs(rows)))
    check(rows[:3], p.pack(docs(rows[:3]), size=64, unit=4), 64)


def test_empty_table(docs):
    assert p.pack(docs([])).collect() == []


def test_given_documents_with_little_padding(given):
    rows = [(r.doc_id, r.text) for r in given.collect()]
    full = check(rows, p.pack(given))
    total = sum(full.values())
    assert len(full) <= total / p.SEQUENCE * 1.02 + 1


@pytest.mark.parametrize("seed", range(4))
def test_cutting_stock(seed):
    rng = np.random.default_rng(seed)
    widths = np.arange(1, 65)
    demand = rng.integers(0, [3, 50, 5000, 2][seed], 64) * (rng.random(64) < [1, 1, 1, 0.1][seed])
    found = p.cutting_stock(widths, demand, 64)
    assert (found.counts @ found.uses == demand).all()
    assert (found.uses @ widths <= 64).all()
    assert found.counts.sum() <= len(p._first_fit(widths, demand, 64)) if seed != 2 else True
    small = demand * (widths <= 20)
    found = p.cutting_stock(widths, small, 64)
    assert (found.counts @ found.uses == small).all()
    assert found.counts.sum() <= np.ceil((small @ widths) / 64) * 1.01 + 2
