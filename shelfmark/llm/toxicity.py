"""Toxicity scores: boosted trees over dense features, calibrated by isotonic regression.

The lexicon is learned: words and word beginnings that labelled toxic texts
have far more often than others. The features of a text are the density and
weight of its lexicon hits, how many stand near a second-person word, capitals,
punctuation, and hits that show up only once disguises (figures for letters,
marks between letters, stretched letters) are undone.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.common import read, values
from shelfmark.llm.quality import bounded, labelled
from shelfmark.session import stage

# Labelled documents that are learned from, at most.
MAX_LABELLED = 40_000
# Entries of the lexicon, at most: the most significant ones.
MAX_LEXICON = 4_000
THRESHOLD = 0.3
# What an entry needs: toxic texts that have it, log odds, and log odds in standard errors.
LEAST_TEXTS, LEAST_ODDS, LEAST_Z = 3, 2.0, 3.0

# Lengths of word beginnings that may be entries, besides whole words.
BEGINNINGS = (4, 5, 6)
# A hit counts as addressed to someone within so many words of a second-person word.
NEAR = 3
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen deiner ihr euch euer tu te toi ton ta tes vous votre"
    " vos tú ti usted ustedes vosotros tus".split()
)
# Figures and marks that stand for letters.
DISGUISE = str.maketrans("013457@$!", "oieastasi")
_EDGES = ".,;:!?\"'()[]{}<>*&%$#-_|/\\"
_STRETCHED = re.compile(r"(.)\1{2,}")
_INSIDE = re.compile(r"[^\w]|_")


def units(word: str) -> list[str]:
    """What a word is looked up as: itself, marked as whole, and its beginnings."""
    return [f"{word} ", *[word[:n] for n in BEGINNINGS if len(word) >= n]]


def plain_words(text: str) -> list[str]:
    return [w.strip(_EDGES) for w in text.lower().split()]


def undisguised(word: str) -> str:
    """The word with letters for figures and marks, without marks inside, stretched letters once."""
    return _STRETCHED.sub(r"\1", _INSIDE.sub("", word.translate(DISGUISE)))


def log_odds(clean: int, toxic: int, n_clean: float, n_toxic: float) -> float:
    """Log odds of a unit in toxic against other texts; 0 unless it is frequent, strong and significant."""
    if toxic < LEAST_TEXTS:
        return 0.0
    odds = math.log((toxic + 0.5) / (n_toxic + 1.0)) - math.log((clean + 0.5) / (n_clean + 1.0))
    error = math.sqrt(1.0 / (toxic + 0.5) + 1.0 / (clean + 0.5))
    return odds if odds >= LEAST_ODDS and odds >= LEAST_Z * error else 0.0


@dataclass(frozen=True)
class Lexicon:
    """Weights of units: in general, and for a text of the sample, whose own count is taken out (by label)."""

    general: dict[str, float]
    own: tuple[dict[str, float], dict[str, float]]


def learn_lexicon(sample: DataFrame, most: int = MAX_LEXICON) -> Lexicon:
    """Units that set toxic texts apart, from rows (text, label).

    Tasks count texts per unit before anything is shuffled. The ``most`` most
    significant units are kept.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, label in zip(values(batch.column("text")), values(batch.column("label")), strict=True):
                seen[int(label >= 0.5)].update({u for w in set(plain_words(text or "")) if w for u in units(w)})
        names = list(seen[1])
        # Units of clean texts alone are no entries, but may be counted as toxic by other tasks.
        names += [u for u in seen[0] if u not in seen[1]]
        for at in range(0, len(names), 50_000):
            part = names[at : at + 50_000]
            yield pa.RecordBatch.from_pydict(
                {"unit": part, "clean": [seen[0][u] for u in part], "toxic": [seen[1][u] for u in part]}
            )

    size = sample.agg(F.count_if(F.col("label") >= 0.5), F.count_if(F.col("label") < 0.5)).first()
    toxic, clean = float(size[0]), float(size[1])
    counts = sample.select("text", "label").mapInArrow(count, "unit string, clean long, toxic long")
    summed = counts.groupBy("unit").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
    error = F.sqrt(1.0 / (F.col("toxic") + 0.5) + 1.0 / (F.col("clean") + 0.5))
    chosen = (
        summed.filter(F.col("toxic") >= LEAST_TEXTS)
        .withColumn("z", odds / error)
        .filter(F.col("z") >= LEAST_Z / 2)
        .orderBy(F.desc("z"), "unit")
        .limit(most)
    ).collect()
    general = {r["unit"]: log_odds(r["clean"], r["toxic"], clean, toxic) for r in chosen}
    in_clean = {r["unit"]: log_odds(r["clean"] - 1, r["toxic"], clean - 1, toxic) for r in chosen if r["clean"]}
    in_toxic = {r["unit"]: log_odds(r["clean"], r["toxic"] - 1, clean, toxic - 1) for r in chosen}
    return Lexicon({k: v for k, v in general.items() if v}, (in_clean, in_toxic))


FEATURES = (
    "hit_density", "hits", "weight_density", "best", "addressed", "address_density", "capitals", "calls", "marks",
    "disguised", "log_words",
)
_PLAIN = re.compile(r"[^\W\d_]+")


def text_features(text: str | None, lexicon: dict[str, float], known: dict[str, float]) -> list[float]:
    """The features of one text, each finite. ``known`` remembers the weights of words."""
    text = text or ""
    words = plain_words(text)
    n = len(words)
    weights = []
    for w in words:
        value = known.get(w)
        if value is None:
            value = known[w] = max((lexicon.get(u, 0.0) for u in units(w)), default=0.0)
        weights.append(value)
    hits = [i for i, v in enumerate(weights) if v]
    hidden = 0
    for i, w in enumerate(words):
        if weights[i] or w.isalpha() and not _STRETCHED.search(w):
            continue
        if w and not _PLAIN.fullmatch(w):
            value = known.get(key := f"\0{w}")
            if value is None:
                bare = undisguised(w)
                value = known[key] = max((lexicon.get(u, 0.0) for u in units(bare)), default=0.0) if len(bare) > 3 else 0.0
            hidden += value > 0
        elif w:
            hidden += any(u in lexicon for u in units(undisguised(w)))
    second = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near = sum(any(abs(i - j) <= NEAR for j in second) for i in hits) if hits and second else 0
    letters = sum(map(len, words)) or 1
    raw = text.encode()
    return [
        len(hits) / max(1, n),
        float(np.log1p(len(hits))),
        sum(weights) / max(1, n),
        max(weights, default=0.0),
        float(near),
        len(second) / max(1, n),
        (len(raw) - len(raw.translate(None, _CAPITALS))) / letters,
        (text.count("!") + text.count("?")) / max(1, n),
        (len(raw) - len(raw.translate(None, _MARKS))) / max(1, n),
        hidden / max(1, n),
        float(np.log1p(n)),
    ]


_CAPITALS = bytes(range(65, 91))
_MARKS = b"#$%&*@^~|"
# Words that a worker remembers.
_REMEMBERED = 150_000


def _array(found: list[list[float]]) -> pa.Array:
    flat = np.array(found, dtype=np.float64).reshape(-1)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1) * len(FEATURES), pa.int32()), pa.array(flat))


def features(lexicon: Lexicon):
    """A Column function from texts to their features."""

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def of(texts: pa.Array) -> pa.Array:
        known: dict[str, float] = {}
        found = []
        for text in values(texts):
            if len(known) > _REMEMBERED:
                known.clear()
            found.append(text_features(text, lexicon.general, known))
        return _array(found)

    return of


def sample_features(lexicon: Lexicon):
    """The same for texts of the lexicon's sample and their labels: what a text itself adds to the counts is left out."""

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def of(texts: pa.Array, labels: pa.Array) -> pa.Array:
        known: tuple[dict, dict] = ({}, {})
        side = [int(v >= 0.5) for v in labels.to_pylist()]
        return _array(
            [text_features(t, lexicon.own[i], known[i]) for t, i in zip(values(texts), side, strict=True)]
        )

    return of


def remainder(id_col: str = "doc_id"):
    """crc32 of the id as text, modulo 4; null ids have none."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4))


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label: str = "toxic",
    most: int = MAX_LABELLED,
    trees: int = 20,
    depth: int = 4,
) -> DataFrame:
    """A row per document: (doc_id, held_out, score, predicted).

    Labels are learned only from ids whose ``remainder`` is not 2. All of them
    give the lexicon; those with 0 and 1 the trees, those with 3 the calibration,
    with features that leave each text's own count out of the lexicon. At most about ``most`` labelled documents are
    used. The score is the calibrated chance in 0..1, ``predicted`` says
    whether it reaches 0.3. Null and empty texts have features of zeros and
    are scored like any other; a null id is not held out. Without labels of
    both kinds every score is the rate of label 1, or 0. An empty table gives
    an empty result.
    """
    known = labelled(labels, label, id_col).filter(remainder() != 2)
    known = stage(bounded(known.withColumn("part", remainder()), most), "labels")
    # At most ``most`` rows, by the bound above: small enough for every task.
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    sample = stage(texts.join(F.broadcast(known), "doc_id"), "labelled")
    lexicon = learn_lexicon(sample)
    of = features(lexicon)
    learned = stage(
        sample.select("part", "label", sample_features(lexicon)("text", "label").alias("f")).coalesce(6), "features"
    ).select("part", (F.col("label") >= 0.5).cast("double").alias("label"), array_to_vector("f").alias("features"))
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), of(F.col(text_col)).alias("_f")
    ).withColumn("features", array_to_vector("_f"))
    kinds = {(r["part"] == 3, r["label"]) for r in learned.select("part", "label").distinct().collect()}
    if len(kinds) == 4:
        forest = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.2, subsamplingRate=0.8, seed=7, maxBins=64)
        model = forest.fit(learned.filter("part <> 3"))
        chance = vector_to_array("probability")[1]
        held = model.transform(learned.filter("part = 3")).withColumn("raw", chance)
        curve = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="score").fit(held)
        scored = curve.transform(model.transform(rows).withColumn("raw", chance))
        # The curve has steps; a thousandth of the uncalibrated chance orders documents on the same one.
        scored = scored.withColumn("score", 0.999 * F.col("score") + 0.001 * F.col("raw"))
    else:
        rate = learned.agg(F.avg("label")).first()[0]
        scored = rows.withColumn("score", F.lit(float(rate or 0.0)))
    return scored.select(
        "doc_id", F.coalesce(remainder() == 2, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
