import hashlib
import random
import string
import zlib
from collections import Counter

import numpy as np
import pytest

from shelfmark.llm import suffixes as s


def brute(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    counts = Counter(b[p : p + length] for _, b in texts for p in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        gone = np.zeros(len(b), dtype=bool)
        for p in range(len(b) - length + 1):
            if counts[b[p : p + length]] > 1:
                gone[p : p + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        runs = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(b) else 0
        out.append((i, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def texts(seed, n=60):
    """Words with shared passages, copies with small changes, and repetition within a text."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    passages = [" ".join(word() for _ in range(rng.randint(3, 40))) for _ in range(6)]
    out = []
    for _ in range(n):
        parts = [" ".join(word() for _ in range(rng.randint(0, 30))) for _ in range(3)]
        parts.insert(rng.randint(0, 3), rng.choice(passages))
        if rng.random() < 0.2:
            parts.append((word() + " ") * rng.randint(5, 60))
        if rng.random() < 0.2 and out:
            old = rng.choice(out)
            at = rng.randint(0, len(old))
            parts = [old[:at], word(), old[at:]]
        out.append("".join(parts))
    return out


@pytest.mark.parametrize(
    ("length", "token", "crowded", "together"), [(40, 8, 20_000, 4_000), (60, 16, 1, 5), (50, 50, 3, 1), (40, 8, 0, 100)]
)
def test_planted_repeats(docs, length, token, crowded, together):
    rows = list(enumerate(texts(length + crowded)))
    rows += [(None, rows[3][1]), (5, rows[5][1]), (5, "another text of this id"), (900, None), (901, ""), (902, "x" * (length - 1))]
    rows += [(903, "x" * length), (904, "x" * (length + 1)), (905, "yz" * 3000), (906, "ü" * length)]
    got = found(s.remove_repeats(docs(rows), length=length, token=token, crowded=crowded, together=together))
    assert got == brute(rows, length)


def test_given_documents(given):
    rows = [(r.doc_id, r.text) for r in given.filter("length(text) < 9000").collect()]
    got = found(s.remove_repeats(given.filter("length(text) < 9000")))
    assert got == brute(rows, s.LENGTH) and any(r[2] for r in got)


def test_empty_table_and_content(spark, docs):
    assert s.remove_repeats(docs([])).collect() == []
    odd = spark.createDataFrame([(1, "a" * 300, 1, 2), (2, "b c", 3, 4)], "doc_id long, text string, crc long, first long")
    got = {r.doc_id: r.kept for r in s.remove_repeats(odd, content=True).collect()}
    assert {i: bytes(k) for i, k in got.items()} == {1: b"", 2: b"b c"}


def test_equal_checksums_without_ids(docs):
    """Texts of other lengths with one CRC-32, null or repeated ids, and parts that other documents repeat."""
    rng = random.Random(8)
    word = lambda n: "".join(rng.choices(string.ascii_letters + string.digits, k=n))
    shared, lead = word(150), (word(90), word(700))
    seen = {zlib.crc32((t := lead[0] + shared + word(9)).encode()): t for _ in range(150_000)}
    pairs = [(seen[c], t) for t in (lead[1] + word(9) for _ in range(150_000)) if (c := zlib.crc32(t.encode())) in seen]
    a, b = pairs[0]
    rows = [(None, a), (None, b), (1, "x" + shared + "y"), (2, lead[1][300:500]), (None, None), (None, ""), (3, a), (3, b), (4, word(80))]
    assert found(s.remove_repeats(docs(rows), length=40, token=8)) == brute(rows, 40)


@pytest.mark.parametrize("n", [39, 40, 41, 500, 5000])
def test_anchors_are_the_least_tokens(n):
    rng = np.random.default_rng(n)
    raw = rng.integers(97, 99 if n % 2 else 120, n).astype(np.uint8).tobytes()
    place, first, count, hash_ = s.anchors(raw, 40, 8)
    assert count.sum() == max(0, n - 39)
    tokens = {}
    for a, f, c, h in zip(place, first, count, hash_, strict=True):
        assert tokens.setdefault(raw[a : a + 8], h) == h
        assert all(i <= a <= i + 32 for i in range(f, f + c))
    at = np.repeat(place, count)
    strings = {}
    for i, a in enumerate(at.tolist()):
        assert strings.setdefault(raw[i : i + 40], a - i) == a - i


def test_stretches_of_a_long_text(monkeypatch):
    raw = np.random.default_rng(0).integers(97, 100, 3000).astype(np.uint8).tobytes() + b"ab" * 400
    whole = s.anchors(raw, 40, 8)
    monkeypatch.setattr(s, "_PLACE", 7)
    at = lambda found: np.repeat(found[0], found[2]).tolist()
    assert at(s.anchors(raw, 40, 8)) == at(whole)
