"""Packing of documents into sequences by cutting-stock column generation.

Documents are cut where they fill whole sequences; what is left of each is one
item. Items are counted by length class. The histogram is a cutting-stock
problem of bounded size whatever the number of documents: its linear program is
solved by column generation, where a knapsack over the classes prices the next
pattern. Pattern counts are rounded down, and the few items left are packed
first-fit decreasing, as further patterns. Documents are then ranked within
their class, and the rank gives the sequence by arithmetic alone. Where the
order of the documents is to be kept, every pattern's sequences are spread
evenly over the numbers, and each class fills them in the order given.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfmark.llm.common import read, values
from shelfmark.operators.ordinals import with_ordinal
from shelfmark.session import stage

SEQUENCE = 4096
# Width of a length class in tokens; it bounds the padding of a piece.
UNIT = 16
END = 2
VOCABULARY = "word_bpe_49k.json"

# What a Python worker remembers: ids of words, which are cheap to put together again, and of their parts, which are not.
_WORDS, _PARTS = 250_000, 500_000
# Latin-1 letters, then ASCII punctuation: the pieces of such a word are those of its two parts.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-/:-@\[-`{-~]*)")


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Remembered(dict):
    """What ``find`` has found for a key."""

    def __init__(self, find: Callable) -> None:
        super().__init__()
        self.find = find

    def __missing__(self, key):
        found = self[key] = self.find(key)
        return found


class WordTokenizer:
    """Ids of texts by a vocabulary that never joins across white space, word by word.

    Words are remembered, as the same ones come again and again. A plain word
    (Latin-1 letters, then punctuation) goes straight to the vocabulary's
    model, anything else through the whole tokenizer; both give the ids that
    the tokenizer gives for the whole text.
    """

    def __init__(self, path: str) -> None:
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.letters = _byte_letters()
        self.words = _Remembered(self._word)
        self.parts = _Remembered(self._part)

    def _part(self, part: str) -> bytes:
        found = self.model.tokenize(part.encode().decode("latin-1").translate(self.letters)) if part else ()
        return struct.pack(f"<{len(found)}I", *[t.id for t in found])

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        plain = _PLAIN.fullmatch(text)
        if plain:
            return self.parts[plain[1].lower()] + self.parts[plain[2]] if plain[2] else self.parts[plain[1].lower()]
        ids = self.whole.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of ``text``."""
        if len(self.words) > _WORDS:
            self.words.clear()
        if len(self.parts) > _PARTS:
            self.parts.clear()
        return b"".join(map(self.words.__getitem__, text.encode().split()))


_LOADED: dict[str, WordTokenizer] = {}


def _tokenizer(vocabulary: str) -> WordTokenizer:
    if vocabulary not in _LOADED:
        _LOADED[vocabulary] = WordTokenizer(public_tokenizers.path(vocabulary))
    return _LOADED[vocabulary]


def pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    end: int = END,
    size: int = SEQUENCE,
    order: Sequence[Column] = (),
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): documents cut into whole sequences and a rest.

    The values of ``order`` follow as ``order_0`` and so on.
    """
    stop = np.array([end], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(vocabulary)
        for batch in batches:
            out: list[tuple] = []
            of: list[int] = []
            for at, (doc_id, text) in enumerate(zip(values(batch.column(0)), values(batch.column(1)), strict=True)):
                ids = tokenizer.ids(text or "") + stop
                total = len(ids) // 4
                for start in range(0, total, size):
                    part = ids[4 * start : 4 * (start + size)]
                    out.append((doc_id, start, len(part) // 4, zlib.crc32(part), total))
                    of.append(at)
            carried = [batch.column(c).take(pa.array(of, pa.int64())) for c in range(2, batch.num_columns)]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [[]] * 5)], *carried],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", *batch.schema.names[2:]],
            )

    keys = [c.alias(f"order_{i}") for i, c in enumerate(order)]
    wanted = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col), *keys)
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    return wanted.mapInArrow(cut, ", ".join([schema, *[f"{f.name} {f.dataType.simpleString()}" for f in wanted.schema[2:]]]))


@dataclass(frozen=True)
class Patterns:
    """``counts[j]`` sequences hold ``uses[j, c]`` items of class ``c`` each."""

    uses: np.ndarray
    counts: np.ndarray


def _price(duals: np.ndarray, widths: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern, by dynamic programming over the capacity."""
    best = np.zeros(capacity + 1)
    took = np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        fits = np.flatnonzero(widths <= room)
        best[room] = best[room - 1]
        if len(fits):
            value = best[room - widths[fits]] + duals[fits]
            at = int(value.argmax())
            if value[at] > best[room]:
                best[room], took[room] = value[at], fits[at]
    pattern = np.zeros(len(widths), dtype=np.int64)
    room = capacity
    while room > 0:
        if took[room] < 0:
            room -= 1
        else:
            pattern[took[room]] += 1
            room -= widths[took[room]]
    return float(best[capacity]), pattern


def cutting_stock(widths: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 2000) -> Patterns:
    """Patterns that hold exactly ``demand`` items of each width, in few stocks of ``capacity``.

    Revised simplex on the covering program min sum x, A x = d, x >= 0. It
    starts from one pattern per class and stops when the knapsack finds no
    pattern worth more than one stock (or after ``rounds``, with a slightly worse
    but valid answer). Rounding down leaves less than one stock per pattern of
    the basis; first-fit decreasing packs what those would have held.
    """
    live = np.flatnonzero(demand > 0)
    w, d = widths[live], demand[live].astype(np.float64)
    n = len(live)
    if not n:
        return Patterns(np.zeros((0, len(widths)), dtype=np.int64), np.zeros(0, dtype=np.int64))
    basis = np.diag(capacity // w).astype(np.float64)  # columns are patterns
    inverse = np.diag(1.0 / basis.diagonal())
    x = inverse @ d
    for round_ in range(rounds):
        if round_ % 50 == 49:
            inverse = np.linalg.inv(basis)
            x = np.maximum(inverse @ d, 0.0)
        value, pattern = _price(inverse.sum(axis=0), w, capacity)
        if value <= 1.0 + 1e-9:
            break
        step = inverse @ pattern
        grows = np.flatnonzero(step > 1e-9)
        ratio = x[grows] / step[grows]
        leaves = grows[int(ratio.argmin())]
        amount = float(ratio.min())
        x = np.maximum(x - amount * step, 0.0)
        x[leaves] = amount
        basis[:, leaves] = pattern
        row = inverse[leaves] / step[leaves]
        inverse -= np.outer(step, row)
        inverse[leaves] = row
    columns = np.round(basis).astype(np.int64)
    counts = np.floor(x + 1e-9).astype(np.int64)
    # Degenerate bases may round above the demand; take whole patterns back until they fit.
    left = demand[live] - columns @ counts
    while (left < 0).any():
        worst = int(left.argmin())
        j = int(np.flatnonzero((columns[worst] > 0) & (counts > 0))[0])
        counts[j] -= 1
        left = demand[live] - columns @ counts
    rest = _first_fit(w, left, capacity)
    uses = np.concatenate([columns.T, rest]) if len(rest) else columns.T
    counts = np.concatenate([counts, np.ones(len(rest), dtype=np.int64)])
    full = np.zeros((len(uses), len(widths)), dtype=np.int64)
    full[:, live] = uses
    return Patterns(full[counts > 0], counts[counts > 0])


def _first_fit(widths: np.ndarray, left: np.ndarray, capacity: int) -> np.ndarray:
    """First-fit decreasing: patterns for the items in ``left``."""
    rooms: list[int] = []
    patterns: list[np.ndarray] = []
    for c in np.argsort(-widths):
        for _ in range(int(left[c])):
            at = next((i for i, room in enumerate(rooms) if room >= widths[c]), None)
            if at is None:
                at = len(rooms)
                rooms.append(capacity)
                patterns.append(np.zeros(len(widths), dtype=np.int64))
            rooms[at] -= int(widths[c])
            patterns[at][c] += 1
    return np.array(patterns) if patterns else np.zeros((0, len(widths)), dtype=np.int64)


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    end: int = END,
    size: int = SEQUENCE,
    unit: int = UNIT,
    order: Sequence[Column] = (),
) -> DataFrame:
    """A row per piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    Every id of every document, its end id included, lies in exactly one piece;
    a sequence holds at most ``size`` tokens, gapless from offset 0. Null and
    empty texts are the end id alone. Repeated rows and rows with equal or null
    ids are packed each on its own. An empty table gives an empty result.

    With ``order``, columns of ``docs`` to sort by, the sequences follow that
    order: each class is ranked by it and spread evenly over ``sequence_id``.
    Ties, and everything without it, go by id. The histogram has ``size / unit``
    classes, so the linear program and the table of patterns do not grow with
    the documents.
    """
    if size % unit:
        raise ValueError("the sequence must be a whole number of classes")
    cut = stage(pieces(docs, id_col, text_col, vocabulary, end, size, order), "pieces")
    sized = cut.withColumn("class", F.ceil(F.col("length") / unit).cast("int")).withColumn(
        "row", F.monotonically_increasing_id()
    )
    classes = size // unit
    counted = {r["class"]: r["n"] for r in sized.groupBy("class").agg(F.count("*").alias("n")).collect()}
    demand = np.array([counted.get(c, 0) for c in range(1, classes + 1)], dtype=np.int64)
    found = cutting_stock(np.arange(1, classes + 1), demand, classes)
    keys = [f"order_{i}" for i in range(len(order))]
    ranked = with_ordinal(sized, ["class", *keys, "doc_id", "start", "row"])
    placed = ranked.join(_slots(docs.sparkSession, found), "ordinal") if keys else _assign(ranked, found, demand)
    # A sequence holds at most ``size`` pieces.
    inside = Window.partitionBy("sequence_id").orderBy("ordinal")
    before = F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
        F.coalesce(before, F.lit(0).cast("bigint")).alias("offset"),
    )


def _assign(ranked: DataFrame, found: Patterns, demand: np.ndarray) -> DataFrame:
    """``sequence_id`` by rank within the class: the patterns take a class's documents in turn."""
    first_of_class = np.r_[0, np.cumsum(demand)]
    first_sequence = np.r_[0, np.cumsum(found.counts)]
    held = found.uses * found.counts[:, None]
    starts = np.cumsum(held, axis=0) - held  # first rank of a class that a pattern takes

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ordinal = batch.column("ordinal").to_numpy()
            c = batch.column("class").to_numpy() - 1
            rank = ordinal - first_of_class[c]
            sequence = np.zeros(len(rank), dtype=np.int64)
            for k in np.unique(c):
                takes = np.flatnonzero(found.uses[:, k])
                mine = c == k
                j = takes[np.searchsorted(starts[takes, k], rank[mine], side="right") - 1]
                sequence[mine] = first_sequence[j] + (rank[mine] - starts[j, k]) // found.uses[j, k]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(batch.num_columns)], pa.array(sequence)],
                names=[*batch.schema.names, "sequence_id"],
            )

    kept = ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "class", "ordinal")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema) + ", sequence_id long"
    return kept.mapInArrow(place, schema)


def _slots(spark: SparkSession, found: Patterns) -> DataFrame:
    """(ordinal, sequence_id): the places of all pieces, by class and then by sequence.

    Sequence t of the n of a pattern stands at (t + 1/2) / n of the whole, so
    that a class comes at an even pace.
    """
    first_sequence = np.r_[0, np.cumsum(found.counts)]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column(0).to_numpy()
            pattern = np.searchsorted(first_sequence, number, side="right") - 1
            at = (number - first_sequence[pattern] + 0.5) / found.counts[pattern]
            yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(pattern), pa.array(at)], names=["number", "pattern", "at"])

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uses = found.uses[batch.column("pattern").to_numpy()]
            row, c = np.nonzero(uses)
            times = uses[row, c]
            sequence = np.repeat(batch.column("sequence_id").to_numpy()[row], times)
            copy = np.arange(len(sequence)) - np.repeat(np.cumsum(times) - times, times)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(c, times)), pa.array(sequence), pa.array(copy)], names=["class", "sequence_id", "copy"])

    numbers = spark.range(int(first_sequence[-1])).mapInArrow(spread, "number long, pattern long, at double")
    sequences = with_ordinal(numbers, ["at", "number"], "sequence_id").select("pattern", "sequence_id")
    places = sequences.mapInArrow(unfold, "class long, sequence_id long, copy long")
    return with_ordinal(places, ["class", "sequence_id", "copy"]).select("ordinal", "sequence_id")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))
