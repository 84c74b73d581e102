"""Language identification by a string kernel, Nyström landmarks and kernel ridge regression.

The kernel of two texts is how many character runs they share, of one to four
characters each (a blended spectrum), presence only, divided by the geometric
mean of how many each has. Runs are hashed to a fixed number of slots, so a text
is a set of slots. Some texts of every language are landmarks: their kernel
matrix gives the Nyström map, in which a ridge regression for each language
against the rest is solved from sums over the sample.

A kernel value is a product of a text's presence vector with a landmark's. The
landmarks' vectors, the map and the weights multiply out to one matrix of slots
by languages, and batches of texts are scored as one sparse product with it.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import read, values
from shelfmark.llm.toxicity import remainder
from shelfmark.session import Steps

# Labelled documents that are learned from, at most, about as many of each language.
MAX_LABELLED = 6_000
# Landmarks among them, and languages that are told apart (the most frequent ones), at most.
MAX_LANDMARKS = 384
MAX_LANGUAGES = 256
# Longest character run, and slots that runs are hashed to, as a power of two.
LONGEST = 4
SLOT_BITS = 18
# Ridge penalty, in shares of the sample.
RIDGE = 1e-3
UNKNOWN = "und"

_BLANK = 32
# Multipliers of the hash: odd numbers of 64 bits.
_NEXT, _SPREAD = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)
# Characters that are looked at together, texts that are scored together, and tasks that sum up the sample.
_CUT = 1 << 20
_TEXTS = 256
_TASKS = 8


@functools.cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([chr(i).isalpha() for i in range(sys.maxunicode + 1)])


class Presence:
    """Finds which slots the character runs of a text fill."""

    def __init__(self, longest: int = LONGEST, bits: int = SLOT_BITS) -> None:
        self.longest, self.shift = longest, np.uint64(64 - bits)
        self.there = np.zeros(1 << bits, dtype=bool)

    def _fill(self, codes: np.ndarray) -> None:
        run = np.zeros(len(codes), dtype=np.uint64)
        for k in range(self.longest):
            if len(codes) <= k:
                break
            run = run[: len(codes) - k] * _NEXT + codes[k:] + np.uint64(1)
            self.there[((run ^ (run >> np.uint64(29))) * _SPREAD) >> self.shift] = True

    def of(self, text: str | None) -> np.ndarray:
        """The filled slots, ascending; none for a text without letters.

        Letters are lower-cased, all that lies between words is one blank, and
        a blank stands at both ends. A long text is read in cuts.
        """
        text = text or ""
        is_letter, blank = _letters(), np.array([_BLANK], dtype=np.uint64)
        carried, any_letter = blank, False
        for at in range(0, len(text), _CUT):
            raw = np.frombuffer(text[at : at + _CUT].lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
            letter = is_letter[raw]
            any_letter = any_letter or bool(letter.any())
            before = np.r_[carried[-1] != _BLANK, letter[:-1]]
            codes = np.r_[carried, np.where(letter, raw, _BLANK)[letter | before].astype(np.uint64)]
            if at + _CUT >= len(text) and codes[-1] != _BLANK:
                codes = np.r_[codes, blank]
            if any_letter:
                self._fill(codes)
            carried = codes[-(self.longest - 1) :] if self.longest > 1 else codes[-1:]
        found = np.flatnonzero(self.there)
        self.there[found] = False
        return found


@dataclass(frozen=True)
class Model:
    """``weights[i]`` are what ``slots[i]`` adds for each language."""

    languages: tuple[str, ...]
    slots: np.ndarray
    weights: np.ndarray

    def scores(self, texts: list[np.ndarray], bits: int = SLOT_BITS) -> np.ndarray:
        """Texts by languages: the product of a batch's presence rows with the weights. Every text has slots."""
        at = np.full(1 << bits, -1, dtype=np.int32)
        at[self.slots] = np.arange(len(self.slots))
        padded = np.concatenate([self.weights, np.zeros((1, len(self.languages)), dtype=self.weights.dtype)])
        edges = np.cumsum([0, *[len(t) for t in texts]])
        product = np.add.reduceat(padded[at[np.concatenate(texts)]], edges[:-1], axis=0, dtype=np.float64)
        return product / np.sqrt(np.diff(edges))[:, None]


def _landmark_kernel(texts: list[np.ndarray], landmarks: list[np.ndarray], bits: int) -> np.ndarray:
    """Kernel values of texts with landmarks."""
    edges = np.cumsum([0, *[len(x) for x in landmarks]])
    side_by_side, sizes = np.concatenate(landmarks), np.diff(edges)
    there = np.zeros(1 << bits, dtype=np.float64)
    out = np.zeros((len(texts), len(landmarks)))
    for i, slots in enumerate(texts):
        there[slots] = 1.0
        out[i] = np.add.reduceat(there[side_by_side], edges[:-1]) / np.sqrt(sizes * len(slots))
        there[slots] = 0.0
    return out


def labelled_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, most: int, languages: int) -> tuple[DataFrame, list[str]]:
    """(doc_id, text, lang): about ``most`` labelled rows, evenly over the languages, and these by name.

    Chosen by a hash of the id; rows with an equal id and language are one.
    """
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    )
    known = texts.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder() != 2))
    counts = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(languages).collect()
    if not counts:
        return known.limit(0), []
    each = max(1, most // len(counts))
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    wanted = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], each / r["n"])])
    chosen = known.filter(share < F.try_element_at(wanted, F.col("lang")))
    return chosen.dropDuplicates(["doc_id", "lang"]), sorted(r["lang"] for r in counts)


def learn(
    sample: DataFrame, languages: list[str], landmarks: int = MAX_LANDMARKS, ridge: float = RIDGE, longest: int = LONGEST, bits: int = SLOT_BITS
) -> Model | None:
    """The model from a bounded sample (doc_id, text, lang); None if no text of it has a letter.

    The driver gets one bit vector per landmark and, from each of a few tasks,
    sums of the size landmarks x (landmarks + languages).
    """
    each = -(-landmarks // len(languages))

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        presence = Presence(longest, bits)
        for batch in batches:
            filled = []
            for text in values(batch.column("text")):
                there = np.zeros(1 << bits, dtype=bool)
                there[presence.of(text)] = True
                filled.append(np.packbits(there).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(filled, pa.binary())], names=["there"])

    by_language = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", "lang"), "doc_id")
    chosen = sample.withColumn("_n", F.row_number().over(by_language)).filter(F.col("_n") <= each)
    rows = chosen.select("text").mapInArrow(slots, "there binary").collect()
    found = sorted({bytes(r["there"]) for r in rows})
    marks = [x for x in (np.flatnonzero(np.unpackbits(np.frombuffer(b, dtype=np.uint8))) for b in found) if len(x)]
    if not marks:
        return None
    m, place = len(marks), {lang: i for i, lang in enumerate(languages)}

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        presence = Presence(longest, bits)
        total = np.zeros((len(languages), m, m))
        first = np.zeros((len(languages), m))
        count = np.zeros(len(languages))
        for batch in batches:
            texts = [presence.of(t) for t in values(batch.column("text"))]
            lang = np.array([place[x] for x in batch.column("lang").to_pylist()])
            able = np.array([len(t) > 0 for t in texts], dtype=bool)
            kernel = _landmark_kernel([t for t in texts if len(t)], marks, bits)
            for c in np.unique(lang[able]):
                mine = kernel[lang[able] == c]
                total[c] += mine.T @ mine
                first[c] += mine.sum(axis=0)
                count[c] += len(mine)
        for c in np.flatnonzero(count):
            yield pa.RecordBatch.from_arrays(
                [pa.array([c], pa.int32()), pa.array([count[c]]), pa.array([first[c].tobytes()], pa.binary()), pa.array([total[c].tobytes()], pa.binary())],
                names=["lang", "n", "first", "total"],
            )

    parts = sample.select("text", "lang").coalesce(_TASKS).mapInArrow(sums, "lang int, n double, first binary, total binary").toLocalIterator()
    count, first, total = np.zeros(len(languages)), np.zeros((len(languages), m)), {}
    for r in parts:
        c = r["lang"]
        count[c] += r["n"]
        first[c] += np.frombuffer(r["first"])
        total[c] = total.get(c, 0.0) + np.frombuffer(r["total"]).reshape(m, m)
    live = np.flatnonzero(count)
    # Every language weighs the same.
    gram = sum(total[c] / count[c] for c in live) / len(live)
    mean = np.stack([first[c] / count[c] / len(live) for c in live], axis=1)
    target = 2 * mean - mean.sum(axis=1, keepdims=True)  # one against the rest: +1 and -1
    value, vector = np.linalg.eigh(_landmark_kernel(marks, marks, bits))
    safe = value > 1e-9 * value[-1]
    nystroem = vector[:, safe] / np.sqrt(value[safe])
    inner = nystroem.T @ gram @ nystroem
    solved = nystroem @ np.linalg.solve(inner + ridge * np.eye(len(inner)), nystroem.T @ target)
    weights = np.zeros((1 << bits, len(live)))
    for x, w in zip(marks, solved, strict=True):
        weights[x] += w / np.sqrt(len(x))
    used = np.unique(np.concatenate(marks))
    return Model(tuple(languages[c] for c in live), used, weights[used].astype(np.float32))


def language_id(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    most: int = MAX_LABELLED,
    landmarks: int = MAX_LANDMARKS,
    languages: int = MAX_LANGUAGES,
    ridge: float = RIDGE,
) -> DataFrame:
    """A row per document: (doc_id, held_out, lang_pred, score).

    Learned only from texts and languages that are there, of ids whose
    ``remainder`` is not 2; a null id is neither learned from nor held out. At
    most about ``most`` documents are learned from, ``landmarks`` of them are
    landmarks, and the ``languages`` most frequent languages are told apart.
    Texts that are null or have no letter, and all texts when nothing could be
    learned, get ``und`` with score 0. Others get the language with the largest
    regression value, ties to the first by name; the score is that value moved
    from -1..1 to 0..1. Repeated rows get a row each. An empty table gives an
    empty result.
    """
    steps = Steps()
    sample, names = labelled_sample(docs, id_col, text_col, lang_col, most, languages)
    model = learn(steps.stage(sample, "labelled"), names, landmarks, ridge) if names else None
    steps.release()

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        presence = Presence()
        for whole in batches:
            for at in range(0, len(whole), _TEXTS):
                batch = whole.slice(at, _TEXTS)
                pred, score = [UNKNOWN] * len(batch), np.zeros(len(batch))
                filled = [presence.of(t) for t in values(batch.column(1))] if model else []
                if rows := [i for i, x in enumerate(filled) if len(x)]:
                    value = model.scores([filled[i] for i in rows])
                    best = value.argmax(axis=1)
                    score[rows] = np.clip((value[np.arange(len(rows)), best] + 1) / 2, 0.0, 1.0)
                    for i, b in zip(rows, best.tolist(), strict=True):
                        pred[i] = model.languages[b]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(pred, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"]
                )

    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col))
    found = texts.mapInArrow(predict, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", F.coalesce(remainder() == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(read(spark, sf_dir, "documents"))
