"""Secret scans with a trigram inverted index.

Each rule's regular expression gives a Boolean query over trigrams that every
match must contain. A run of texts of one task is a segment of the index: a
postings list per trigram that some rule asks for, the lists of a query
intersected and united, and the rule's expression run on the candidates only.
Rules without mandatory trigrams scan the whole segment. A segment needs
nothing from other rows, so nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.common import read

try:  # Python 3.11 and later
    from re import _constants as _sre, _parser
except ImportError:  # pragma: no cover
    import sre_constants as _sre
    import sre_parse as _parser

# A query is None (no condition), a trigram, or ("and" | "or", parts).
Query = None | str | tuple
# Texts of a segment of the index.
SEGMENT = 1024
# Larger sets of alternatives are not followed.
_MAX_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its expression, and the least length of a group of it.

    ``finder`` gives the matches of an expression that would look at a long run
    of letters again from each of them; it reads every run once.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    query: Query = field(default=None, compare=False)
    finder: Callable[[str], list[tuple[int, int]]] | None = None

    def spans(self, text: str) -> list[tuple[int, int]]:
        if self.finder is not None:
            return self.finder(text)
        found = re.finditer(self.pattern, text)
        return [m.span() for m in found if m.end(self.group) - m.start(self.group) >= self.least]


# What comes before "://", from the start of the run on, and what must follow it.
_SCHEME = re.compile(r"(?<![a-z0-9+.-])[a-z0-9+.-]+://")
_LETTER = re.compile(r"[a-z]")
_LOGIN = re.compile(r"[^\s/:@]+:[^\s/@]+@")
# A whole run that two more parts of a token follow.
_PARTS = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{11,}(?=(\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}))")


def _url_spans(text: str) -> list[tuple[int, int]]:
    """A match begins at the first letter of the run before "://"; neither a run nor what follows reaches another one."""
    found = []
    for run in _SCHEME.finditer(text):
        letter, login = _LETTER.search(text, run.start(), run.end() - 3), _LOGIN.match(text, run.end())
        if letter and login:
            found.append((letter.start(), login.end()))
    return found


def _jwt_spans(text: str) -> list[tuple[int, int]]:
    """A match begins at the first "eyJ" of a run that enough letters follow, and ends with the second run after it."""
    found, done = [], 0
    for run in _PARTS.finditer(text):
        at = text.find("eyJ", run.start(), run.end() - 8)
        if at >= 0 and run.start() >= done:
            done = run.end(1)
            found.append((at, done))
    return found


BASE_KINDS = ("assign", "access", "hex")
# The expressions and least lengths of the three base kinds. The last two hold their least length as
# a repeat count: a run is matched whole, so that is the same as matching any run and dropping the short ones.
BASE_RULES = (
    Rule(
        "assign",
        r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
# What this scan finds beyond the base kinds.
ADDED_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", finder=_jwt_spans),
    Rule("hub", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("bearer", r"(?ai:authorization)\x20*:\x20*(?ai:bearer)\x20+([A-Za-z0-9+/_.=-]+)", group=1, least=16),
    Rule("url", r"[a-z][a-z0-9+.-]*://[^\s/:@]+:([^\s/@]+)@", group=1, least=1, finder=_url_spans),
)
RULES = BASE_RULES + ADDED_RULES


def _both(kind: str, parts: list[Query]) -> Query:
    if kind == "or" and any(p is None for p in parts):
        return None
    parts = list(dict.fromkeys(p for p in parts if p is not None))
    if not parts:
        return None
    return parts[0] if len(parts) == 1 else (kind, tuple(parts))


def _grams(strings: set[str]) -> Query:
    """Every text that contains one of ``strings`` satisfies this."""
    return _both("or", [_both("and", [s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def _walk(items) -> tuple[set[str] | None, Query]:
    """The strings a sequence can be (in lower case; None if not known), and a condition on its matches."""
    exact, runs, whole = {""}, [], True
    for op, arg in items:
        strings, condition = _node(op, arg)
        joined = {a + b for a in exact for b in strings} if strings is not None else None
        if joined is not None and len(joined) <= _MAX_STRINGS:
            exact = joined
            continue
        runs += [_grams(exact), condition]
        exact = strings if strings is not None else {""}
        whole = False
    if whole:
        return exact, _grams(exact)
    return None, _both("and", [*runs, _grams(exact)])


def _node(op, arg) -> tuple[set[str] | None, Query]:
    if op is _sre.LITERAL:
        return {chr(arg).lower()}, None
    if op is _sre.SUBPATTERN:
        return _walk(arg[3])
    if op is _sre.BRANCH:
        sides = [_walk(side) for side in arg[1]]
        strings = set().union(*[s for s, _ in sides if s is not None])
        if all(s is not None for s, _ in sides) and len(strings) <= _MAX_STRINGS:
            return strings, None
        return None, _both("or", [q for _, q in sides])
    if op in (_sre.MAX_REPEAT, _sre.MIN_REPEAT):
        low, high, inner = arg
        strings, condition = _walk(inner)
        if low == 0 and high == 1 and strings is not None:
            return strings | {""}, None
        return None, condition if low else None
    if op is _sre.IN and not any(o is _sre.NEGATE for o, _ in arg):
        letters: set[str] = set()
        for o, a in arg:
            if o is _sre.LITERAL:
                letters.add(chr(a).lower())
            elif o is _sre.RANGE and a[1] - a[0] < _MAX_STRINGS:
                letters |= {chr(c).lower() for c in range(a[0], a[1] + 1)}
            else:
                return None, None
        return (letters, None) if len(letters) <= 4 else (None, None)
    return None, None


def trigram_query(pattern: str) -> Query:
    """A Boolean query over lower-case trigrams that every match of ``pattern`` satisfies; None if there is none."""
    return _walk(_parser.parse(pattern))[1]


def query_trigrams(query: Query) -> set[str]:
    if query is None:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(query_trigrams, query[1]))


class Segment:
    """Postings of one batch of texts for the trigrams that rules ask for."""

    def __init__(self, texts: list[str], trigrams: set[str]) -> None:
        self.size = len(texts)
        lowered = [t.lower() for t in texts]
        self.postings = {
            g: np.fromiter((i for i, t in enumerate(lowered) if g in t), dtype=np.int64) for g in trigrams
        }

    def candidates(self, query: Query) -> np.ndarray:
        """Ordinals of the texts that satisfy ``query``, in order."""
        if query is None:
            return np.arange(self.size)
        if isinstance(query, str):
            return self.postings[query]
        kind, parts = query
        lists = sorted((self.candidates(p) for p in parts), key=len)
        out = lists[0]
        for other in lists[1:]:
            out = np.intersect1d(out, other, assume_unique=True) if kind == "and" else np.union1d(out, other)
        return out


def scan_segment(texts: list[str], rules: tuple[Rule, ...], queries: list[Query]) -> list[list[tuple[int, int, int]]]:
    """Per text the spans (start, rule number, end), sorted."""
    segment = Segment(texts, set().union(*map(query_trigrams, queries)))
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for number, (rule, query) in enumerate(zip(rules, queries, strict=True)):
        for i in segment.candidates(query).tolist():
            found[i] += [(a, number, b) for a, b in rule.spans(texts[i])]
    for spans in found:
        spans.sort()
    return found


_SPAN = T.StructType(
    [T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]
)


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """(doc_id, spans) per row: every match of every rule, as (kind, start, end) in code points, end exclusive.

    Matches of one kind do not overlap and are taken from left to right; those
    whose group is too short are dropped after that. Sorted by start, then in
    the order of ``rules``. Null texts count as empty; a row without matches
    has an empty list; repeated rows are scanned each; ids may be null.
    """
    queries = [trigram_query(r.pattern) for r in rules]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("spans", T.ArrayType(_SPAN))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[list[tuple[int, int, int]]] = []
            for at in range(0, len(batch), SEGMENT):
                texts = [t or "" for t in batch.column(1).slice(at, SEGMENT).to_pylist()]
                found += scan_segment(texts, rules, queries)
            flat = [s for spans in found for s in spans]
            items = pa.StructArray.from_arrays(
                [
                    pa.array([rules[n].kind for _, n, _ in flat], pa.string()),
                    pa.array([a for a, _, _ in flat], pa.int64()),
                    pa.array([b for _, _, b in flat], pa.int64()),
                ],
                names=["kind", "start", "end"],
            )
            offsets = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(offsets, items)], names=["doc_id", "spans"]
            )

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col)).mapInArrow(scan, schema)


def digest_of(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(read(spark, sf_dir, "documents"))
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )
    of_kind = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *[of_kind(k).alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
