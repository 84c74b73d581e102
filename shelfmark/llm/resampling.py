"""Importance resampling towards a target distribution of hashed word runs.

Runs of one to three words are hashed into buckets. A first pass counts the
buckets of the corpus, task by task, and of the target; the logarithm of their
smoothed ratio is a bucket's gain. A second pass scores every document as a sum
of gains out of an array. Gumbel noise from a hash of the id is added, and the
documents with the highest sums are a sample without replacement.

The cutoff is found by weighted medians of medians. Every partition of the
scores tells the median of its remaining keys; the median of these, weighted by
how many keys remain, has a quarter of all remaining keys on either side for
certain. Counting decides the side, the other one is discarded, and so on to the
exact cutoff key. Only the winners are sorted.

A hash of a word run is never taken from its bytes: CRC-32 is linear, so the
code of joined words follows from the codes of the words. That makes the passes
array operations over the bytes of a whole batch.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import read, text_bytes
from shelfmark.operators.ordinals import with_ordinal
from shelfmark.session import Steps, stage

BUCKETS = 10_000
LONGEST = 3
SEED = 42
PERCENT = 5
LEAST_WORDS = 20
# Keys that are sorted at once when no more remain.
LAST = 4_096
# The remaining keys are written anew once they are a quarter of a table of at least so many.
REWRITE = 4_000_000

_POLYNOMIAL = 0xEDB88320
# Bytes of texts that are looked at together, and words whose runs are.
_SPAN = 1 << 22
_WORDS = 1 << 19
# Words up to this many bytes are hashed side by side.
_SHORT = 64


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


_TABLE = _crc_table()
_BYTES = np.arange(256)
# What a word is, once A-Z are in lower case.
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same by bytes: digits, letters and all bytes of other characters.
_IN_WORD = ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 65) & (_BYTES <= 90)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)


def _zero_byte(code: np.ndarray) -> np.ndarray:
    return _TABLE[code & 255] ^ (code >> 8)


@functools.cache
def _shifts() -> tuple[np.ndarray, np.ndarray]:
    """What each byte of a code becomes under n zero bytes: for n up to ``_SHORT`` + 1, and for powers of two."""
    small = [(np.arange(256, dtype=np.uint32)[None, :] << np.array([[0], [8], [16], [24]], dtype=np.uint32)).astype(np.uint32)]
    for _ in range(_SHORT + 1):
        small.append(_zero_byte(small[-1]))
    powers = [small[1]]
    for _ in range(40):
        powers.append(_applied(powers[-1], powers[-1]))
    return np.stack(small), np.stack(powers)


def _applied(table: np.ndarray, code: np.ndarray) -> np.ndarray:
    return table[0][code & 255] ^ table[1][(code >> 8) & 255] ^ table[2][(code >> 16) & 255] ^ table[3][code >> 24]


def _shifted(code: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Codes after ``by`` zero bytes each."""
    small, powers = _shifts()
    n = np.minimum(by, _SHORT + 1)
    out = small[n, 0, code & 255] ^ small[n, 1, (code >> 8) & 255] ^ small[n, 2, (code >> 16) & 255] ^ small[n, 3, code >> 24]
    far = np.flatnonzero(by > _SHORT + 1)
    if len(far):
        moved, rest, bit = code[far], by[far].copy(), 0
        while rest.any():
            odd = (rest & 1).astype(bool)
            moved[odd] = _applied(powers[bit], moved[odd])
            rest >>= 1
            bit += 1
        out[far] = moved
    return out


def _hashed(data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of the words at ``begin``; ``data`` is in lower case."""
    code = np.zeros(len(begin), dtype=np.uint32)
    order = np.argsort(length, kind="stable")[::-1]
    long = int(np.count_nonzero(length > _SHORT))
    for i in order[:long]:
        code[i] = zlib.crc32(data[begin[i] : begin[i] + length[i]].tobytes())
    short = order[long:]
    if len(short):
        at, left = begin[short], length[short]
        now = np.full(len(short), 0xFFFFFFFF, dtype=np.uint32)
        # Words with more than i bytes stand in front.
        alive = len(short) - np.cumsum(np.bincount(left, minlength=_SHORT + 1))
        for i in range(int(left[0])):
            k = int(alive[i])
            now[:k] = _TABLE[(now[:k] ^ data[at[:k] + i]) & 255] ^ (now[:k] >> 8)
        code[short] = now ^ np.uint32(0xFFFFFFFF)
    return code


def _words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code, length, text) of every word of texts that begin at ``starts``."""
    inside = _IN_WORD[data]
    if not inside.any():
        return np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[starts] = True
    before = np.r_[False, inside[:-1]] & ~edge[:-1]
    after = np.r_[inside[1:], False] & ~edge[1:]
    begin = np.flatnonzero(inside & ~before)
    length = np.flatnonzero(inside & ~after) + 1 - begin
    text = np.searchsorted(starts, begin, side="right") - 1
    return _hashed(_LOWER[data], begin, length), length, text


def _spans(data: np.ndarray, starts: np.ndarray, span: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first text, code, length, text) of the words of texts taken together; a longer text comes alone, read in cuts."""
    first, n = 0, len(starts) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + span, side="right")) - 1)
        part = data[starts[first] : starts[last]]
        if len(part) <= span:
            yield first, *_words(part, starts[first : last + 1] - starts[first])
        else:
            found, at = [], 0
            while at < len(part):
                end = min(len(part), at + span)
                while end < len(part) and _IN_WORD[part[end - 1]] and _IN_WORD[part[end]]:
                    ahead = np.flatnonzero(~_IN_WORD[part[end : end + span]])
                    end = end + int(ahead[0]) if len(ahead) else min(len(part), end + span)
                found.append(_words(part[at:end], np.array([0, end - at]))[:2])
                at = end
            code, length = (np.concatenate([f[i] for f in found]) for i in range(2))
            yield first, code, length, np.zeros(len(code), dtype=np.int64)
        first = last


def runs(column: pa.Array, buckets: int = BUCKETS, longest: int = LONGEST, span: int = _SPAN) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(words in a run, bucket, text) of all runs of up to ``longest`` words, in arrays of bounded size."""
    data, starts = text_bytes(column)
    blank = np.full(1, zlib.crc32(b" "), dtype=np.uint32)
    for first, code, length, text in _spans(data, starts, span):
        for at in range(0, len(code), _WORDS):
            some = slice(at, at + _WORDS + longest - 1)
            c, n, t = code[some], length[some], text[some]
            after_blank = _shifted(np.broadcast_to(blank, len(c)), n) ^ c
            run = c
            for k in range(1, longest + 1):
                m = len(c) - k + 1
                if m <= 0:
                    break
                if k > 1:  # the next word follows after a blank
                    run = _shifted(run[:m], n[k - 1 :] + 1) ^ after_blank[k - 1 :]
                own = min(_WORDS, m)
                same = t[:own] == t[k - 1 : k - 1 + own]
                yield k, (run[:own][same] % np.uint32(buckets)).astype(np.int64), t[:own][same] + first


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """How often each bucket comes in all texts. Every task sends one row per bucket that it has seen."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, bucket, _ in runs(batch.column(0), buckets, longest):
                seen += np.bincount(bucket, minlength=buckets)
        there = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(seen[there])], names=["bucket", "n"])

    total = np.zeros(buckets, dtype=np.int64)
    found = texts.select(F.col(text_col)).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for r in found.collect():
        total[r["bucket"]] = r["n"]
    return total


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of each bucket's smoothed share in the target against that in the corpus."""
    n, all_corpus, all_target = len(corpus), float(corpus.sum()), float(target.sum())
    ratio = [(t + 1.0) * (all_corpus + n) / ((s + 1.0) * (all_target + n)) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(1000.0 * math.log(r)) for r in ratio], dtype=np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str, longest: int = LONGEST) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every document."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(batch)
            words, features, weight = (np.zeros(n, dtype=np.int64) for _ in range(3))
            for k, bucket, text in runs(batch.column(1), len(gain), longest):
                number = np.bincount(text, minlength=n)
                features += number
                words += number * (k == 1)
                # Doubles are exact: sums of integers far below 2**53.
                weight += np.bincount(text, gain[bucket], minlength=n).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(x) for x in (words, features, weight)]],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col))
    return rows.mapInArrow(score, "doc_id long, n_words long, n_features long, weight long")


def gumbel(id_: Column, seed: int = SEED) -> Column:
    """floor(1000 * Gumbel noise) from a hash of the id; a null id counts as empty text."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256), 1, 8)
    share = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000.0 * F.log(-F.log(share))).cast("bigint")


_KEY = ("k0", "k1", "k2", "k3")
Key = tuple[int, ...]


def _median(keys: np.ndarray) -> list[int] | None:
    """The lower median of the rows of ``keys``, as tuples in order."""
    if not len(keys):
        return None
    order = np.lexsort(keys.T[::-1])
    return keys[order[(len(keys) - 1) // 2]].tolist()


def _weighted_median(found: list[tuple[int, Key]]) -> Key:
    """The first median, in order, that half of the weight does not exceed."""
    half, seen = sum(n for n, _ in found) / 2, 0
    for n, key in sorted(found, key=lambda x: x[1]):
        seen += n
        if seen >= half:
            return key
    raise ValueError("no medians")


def _within(low: Key | None, high: Key | None) -> Column:
    """Whether a key is above ``low`` and not above ``high``; the bounds of its first part reach the scan."""
    key, out = F.struct(*_KEY), F.lit(True)
    bound = lambda k: F.struct(*[F.lit(v).cast("bigint").alias(c) for c, v in zip(_KEY, k, strict=True)])
    if low is not None:
        out = out & (F.col("k0") >= low[0]) & (key > bound(low))
    if high is not None:
        out = out & (F.col("k0") <= high[0]) & (key <= bound(high))
    return out


def cutoff(keys: DataFrame, take: int, last: int = LAST, rewrite: int = REWRITE) -> Key | None:
    """The key that exactly ``take`` keys do not exceed; None if there are fewer or none are to be taken.

    ``keys`` has long columns k0 to k3; no two rows are equal. A round is one
    job, in which every partition sends two sizes and two medians: those on
    either side of the last pivot.
    """
    steps = Steps()
    total = keys.count()
    if take <= 0 or take > total:
        return None

    def halves(pivot: Key | None):
        def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            some = [np.stack([b.column(c).to_numpy() for c in _KEY], axis=1) for b in batches if len(b)]
            rows = np.concatenate(some) if some else np.zeros((0, len(_KEY)), dtype=np.int64)
            if pivot is None:
                low = np.ones(len(rows), dtype=bool)
            else:
                low, same = np.zeros(len(rows), dtype=bool), np.ones(len(rows), dtype=bool)
                for c, v in enumerate(pivot):
                    low |= same & (rows[:, c] < v)
                    same &= rows[:, c] == v
                low |= same
            sides = [rows[low], rows[~low]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([0, 1], pa.int32()),
                    pa.array([len(x) for x in sides], pa.int64()),
                    pa.array([_median(x) for x in sides], pa.list_(pa.int64())),
                ],
                names=["side", "n", "median"],
            )

        return of

    low: Key | None = None
    high: Key | None = None
    pivot: Key | None = None
    held = remaining = total
    try:
        while True:
            if remaining <= last:
                rows = sorted(tuple(r) for r in keys.filter(_within(low, high)).select(*_KEY).collect())
                return rows[take - 1]
            if remaining >= rewrite and remaining * 4 <= held:
                keys, held = steps.stage(keys.filter(_within(low, high)), "remaining"), remaining
            found = keys.filter(_within(low, high)).select(*_KEY).mapInArrow(halves(pivot), "side int, n long, median array<long>").collect()
            sides = [[(r["n"], tuple(r["median"])) for r in found if r["side"] == s and r["n"]] for s in (0, 1)]
            below = sum(n for n, _ in sides[0])
            if pivot is None or take < below:
                side, high = 0, pivot
            elif take == below:
                return pivot
            else:
                side, low, take = 1, pivot, take - below
            remaining = sum(n for n, _ in sides[side])
            if remaining > last:
                pivot = _weighted_median(sides[side])
    finally:
        steps.release()


def resampled(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    seed: int = SEED,
    last: int = LAST,
) -> DataFrame:
    """A row per document: (doc_id, n_features, weight, score, rank).

    Words are runs of digits, a-z and characters beyond ASCII, after A-Z are
    lower-cased; null texts have none. A document without runs has weight 0. Of
    the documents with ``least_words`` words or more, ``percent`` in a hundred,
    rounded down, are drawn: the highest scores, ties to the smaller id, null
    ids last, repeated ids in any order; their rank counts from 1, others have
    none. An empty target counts nothing; an empty table gives an empty result.
    """
    gain = gains(bucket_counts(docs, text_col, buckets, longest), bucket_counts(target, target_col, buckets, longest))
    found = weighed(docs, gain, id_col, text_col, longest)
    scored = stage(
        found.withColumns({"score": F.col("weight") + gumbel(F.col("doc_id"), seed), "k3": F.monotonically_increasing_id()}), "scores"
    ).withColumns({"k0": -F.col("score"), "k1": F.isnull("doc_id").cast("bigint"), "k2": F.coalesce("doc_id", F.lit(0).cast("bigint"))})
    able = F.col("n_words") >= least_words
    candidates = scored.filter(able)
    edge = cutoff(candidates.select(*_KEY), percent * candidates.count() // 100, last)
    out = ("doc_id", "n_features", "weight", "score")
    if edge is None:
        return scored.select(*out, F.lit(None).cast("bigint").alias("rank"))
    drawn = able & _within(None, edge)
    winners = with_ordinal(scored.filter(drawn).select(*out, *_KEY), _KEY).select(*out, (F.col("ordinal") + 1).alias("rank"))
    return winners.unionByName(scored.filter(~drawn).select(*out, F.lit(None).cast("bigint").alias("rank")))


def _sql() -> str:
    """The same by plain SQL; CRC-32 goes byte by byte over the hexadecimal form of every distinct run."""
    bits = [int(_TABLE[1 << i]) for i in range(8)]
    terms = [f"((xor(c, b) >> {i}) & 1) * {k}" for i, k in enumerate(bits)]
    folded = functools.reduce(lambda a, b: f"xor({a}, {b})", terms)
    digit = "(strpos('0123456789ABCDEF', h[{at}]) - 1)"
    as_bytes = (
        f"list_transform(range(1, length(h), 2), lambda i: ({digit.format(at='i')} * 16 + {digit.format(at='i + 1')})::bigint)"
    )
    crc = f"xor(list_reduce(list_prepend(4294967295::bigint, {as_bytes}), lambda c, b: xor({folded}, c >> 8)), 4294967295::bigint)"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{_WORD}')"
    joined = "array_to_string(w[i : i + k - 1], ' ')"
    listed = "unnest(range(1, len(w) + 1)) i"
    return (
        f"with words as materialized (select doc_id, true corpus, {words} w from documents union all select item_id, false, {words} from benchmark),"
        f" grams as materialized (select doc_id, corpus, {joined} f from (select doc_id, corpus, w, {listed} from words),"
        f" range(1, {LONGEST + 1}) t(k) where i + k - 1 <= len(w)),"
        f" hashed as materialized (select f, ({crc}) % {BUCKETS} bucket from (select f, hex(encode(f)) h from (select distinct f from grams))),"
        " counted as (select bucket, count(*) filter (corpus) s, count(*) filter (not corpus) t from grams join hashed using (f) group by bucket),"
        " totals as (select sum(s)::double a, sum(t)::double b from counted),"
        f" gain as (select bucket, floor(1000 * ln((t + 1)::double * (a + {BUCKETS}) / ((s + 1)::double * (b + {BUCKETS}))))::bigint g from counted, totals),"
        " summed as (select doc_id, count(*) n, sum(g)::bigint weight from grams join hashed using (f) join gain using (bucket) where corpus group by doc_id),"
        " scored as (select d.doc_id, len(d.w) words, coalesce(n, 0) n_features, coalesce(weight, 0) weight, coalesce(weight, 0)"
        f" + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || d.doc_id), 1, 8))::bigint + 0.5::double) / 4294967296)))::bigint score"
        " from words d left join summed s on s.doc_id = d.doc_id where d.corpus),"
        f" ranked as (select doc_id, row_number() over (order by score desc, doc_id) r, count(*) over () n from scored where words >= {LEAST_WORDS})"
        f" select doc_id, n_features, weight, score, r rank from scored left join (select * from ranked where r <= {PERCENT} * n // 100) using (doc_id)"
    )


SQL = _sql()


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
