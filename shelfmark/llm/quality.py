"""Quality classifier: document evidence combined with site posteriors by hierarchical empirical Bayes.

A logistic regression over a few figures of each text gives a likelihood ratio
of good against bad. Sites form a hierarchy: all documents, hosts, paths of a
host. A site's rate of good documents comes from grouped sums over all its
documents and is shrunk towards the level above it, the more so the fewer
documents it has; how much is estimated from the spread between the sites. The
score of a document is the posterior from its path's rate and its own evidence.
"""

from __future__ import annotations

import operator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.common import fresh, read, values
from shelfmark.session import stage

# Labelled documents that the regression is fitted on, at most.
MAX_LABELLED = 40_000
# Documents with a posterior below this are rejected.
THRESHOLD = 0.5

FIGURES = (
    "log_words", "word_length", "distinct", "repeated", "same_as_next", "capitals", "shouted", "marks", "bars",
    "digits", "line_repeats",
)
_CAPITALS = bytes(range(65, 91))
_LETTERS = _CAPITALS + bytes(range(97, 123)) + bytes(range(128, 256))
_DIGITS = bytes(range(48, 58))
_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,'-|")


def _share(raw: bytes, of: bytes) -> float:
    return (len(raw) - len(raw.translate(None, of))) / max(1, len(raw))


def text_figures(text: str | None) -> list[float]:
    """The figures of one text, each finite; null counts as empty."""
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    lines = [x for x in raw.split(b"\n") if x]
    letters = _share(raw, _LETTERS)
    kinds = set(words)
    return [
        float(np.log1p(n)),
        sum(map(len, words)) / max(1, n),
        len(kinds) / max(1, n),
        1.0 - min(1.0, len(kinds) / max(1.0, n**0.8)),
        sum(map(operator.eq, words, words[1:])) / max(1, n),
        _share(raw, _CAPITALS) / max(1e-9, letters) if letters else 0.0,
        raw.count(b"!!") / max(1, n),
        (len(raw) - len(raw.translate(None, _MARKS))) / max(1, n),
        raw.count(b"|") / max(1, n),
        _share(raw, _DIGITS),
        1.0 - len(set(lines)) / max(1, len(lines)) if lines else 0.0,
    ]


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def figures(texts: pa.Array) -> pa.Array:
    found = [text_figures(t) for t in values(texts)]
    flat = np.array(found, dtype=np.float64).reshape(-1)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1) * len(FIGURES), pa.int32()), pa.array(flat))


def labelled(labels: DataFrame, label: str, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, label): one row per labelled id, the mean where labels of it differ."""
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label).isNotNull())
    return known.groupBy(F.col(id_col).cast("bigint").alias("doc_id")).agg(
        F.avg(F.col(label).cast("double")).alias("label")
    )


def bounded(rows: DataFrame, most: int) -> DataFrame:
    """About ``most`` of ``rows``, or all of them, chosen by a hash of doc_id."""
    n = rows.count()
    if n <= most:
        return rows
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rows.filter(share < most / n)


def fit_evidence(sample: DataFrame) -> list[float] | None:
    """Intercept and weights of the log odds of good against bad, at even odds; None without both kinds.

    ``sample`` has ``figures`` and ``label``. The classes are weighted evenly,
    so the log odds are a log likelihood ratio.
    """
    rows = sample.select(array_to_vector("figures").alias("features"), (F.col("label") >= 0.5).cast("double").alias("label"))
    counted = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(counted) < 2:
        return None
    n = sum(counted.values())
    weight = F.when(F.col("label") == 1.0, n / (2.0 * counted[1.0])).otherwise(n / (2.0 * counted[0.0]))
    model = LogisticRegression(weightCol="weight", regParam=0.002, maxIter=60).fit(rows.withColumn("weight", weight))
    return [float(model.intercept), *map(float, model.coefficients)]


def evidence(model: list[float] | None, of: Column) -> Column:
    """Log likelihood ratio of good against bad, within +-20."""
    if model is None:
        return F.lit(0.0)
    total = F.lit(model[0])
    for i, w in enumerate(model[1:]):
        total = total + F.lit(w) * of[i]
    return F.greatest(F.lit(-20.0), F.least(F.lit(20.0), total))


def _logit(p: Column) -> Column:
    return F.log(p / (F.lit(1.0) - p))


def _strength(sites: DataFrame, above: Column) -> float:
    """How many documents the level above counts for, by moments.

    The spread of the sites' rates around the level above, beyond what chance
    gives for their sizes, is the variance between sites.
    """
    rate = F.col("good") / F.col("n")
    row = sites.agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * (rate - above) ** 2).alias("spread"),
        F.sum(above * (1 - above)).alias("chance"),
        F.sum(F.col("n") * above * (1 - above)).alias("within"),
    ).first()
    if not row["n"]:
        return 1.0
    between = max((row["spread"] - row["chance"]) / row["n"], 1e-6)
    return float(min(1e6, max(1.0, row["within"] / row["n"] / between - 1.0)))


def site_posteriors(scored: DataFrame) -> DataFrame:
    """(host, path, host_posterior, path_posterior) from rows (host, path, good); ``good`` is in 0..1.

    Sums are combined in each task before the shuffle, so a host with a third
    of all documents is a few rows. A path without documents of its own has no
    row here.
    """
    paths = stage(scored.groupBy("host", "path").agg(F.sum("good").alias("good"), F.count("*").alias("n")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    top = hosts.agg(F.sum("good").alias("good"), F.sum("n").alias("n")).first()
    # One good and one bad document in addition keep the rate off 0 and 1.
    overall = ((top["good"] or 0.0) + 1.0) / ((top["n"] or 0) + 2.0)
    of_hosts = _strength(hosts, F.lit(overall))
    shrunk = (F.col("good") + of_hosts * overall) / (F.col("n") + of_hosts)
    hosts = hosts.select(F.col("host").alias("_h"), shrunk.alias("host_posterior"))
    joined = paths.join(hosts, F.col("host").eqNullSafe(F.col("_h"))).drop("_h")
    of_paths = _strength(joined, F.col("host_posterior"))
    posterior = (F.col("good") + of_paths * F.col("host_posterior")) / (F.col("n") + of_paths)
    return joined.select("host", "path", "host_posterior", posterior.alias("path_posterior"))


class QualityModel:
    """Fitted evidence and site posteriors."""

    def __init__(self, weights: list[float] | None, sites: DataFrame, host: Column, path: Column) -> None:
        self.weights, self.sites, self.host, self.path = weights, sites, host, path

    def score(self, docs: DataFrame, of: Column, columns: list[Column]) -> DataFrame:
        """``columns`` of ``docs`` with evidence, host_posterior, path_posterior and quality."""
        h, p, e = (fresh(docs, c) for c in ("_h", "_p", "_e"))
        sites = self.sites.withColumnsRenamed({"host": h, "path": p})
        on = self.host.eqNullSafe(F.col(h)) & self.path.eqNullSafe(F.col(p))
        rows = docs.withColumn(e, evidence(self.weights, of)).join(sites, on, "left")
        total = F.col(e) + _logit(F.col("path_posterior"))
        return rows.select(
            *columns, F.col(e).alias("evidence"), "host_posterior", "path_posterior",
            (F.lit(1.0) / (F.lit(1.0) + F.exp(-total))).alias("quality"),
        )


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host: Column | None = None,
    path: Column | None = None,
    label: str = "quality",
    most: int = MAX_LABELLED,
) -> tuple[QualityModel, DataFrame]:
    """The model, and a staged row (doc_id, host, path, figures) for each document.

    The regression is fitted on at most about ``most`` labelled documents;
    sites are counted over all documents: a labelled one with its label, any
    other with the probability that its evidence and the overall rate give.
    """
    host = F.col("source") if host is None else host
    path = F.col("lang") if path is None else path
    wanted = [F.col(id_col).cast("bigint").alias("doc_id"), host.alias("host"), path.alias("path")]
    narrow = stage(docs.select(*wanted, figures(F.col(text_col)).alias("figures")), "figures")
    known = stage(labelled(labels, label, id_col), "labels")
    sample = narrow.join(bounded(known, most), "doc_id")
    weights = fit_evidence(sample)
    rate = known.agg(F.avg("label")).first()[0]
    prior = float(np.clip(0.5 if rate is None else rate, 1e-3, 1 - 1e-3))
    own = evidence(weights, F.col("figures")) + float(np.log(prior / (1 - prior)))
    guess = F.lit(1.0) / (F.lit(1.0) + F.exp(-own))
    scored = narrow.join(known, "doc_id", "left").select("host", "path", F.coalesce("label", guess).alias("good"))
    return QualityModel(weights, stage(site_posteriors(scored), "sites"), host, path), narrow


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **columns) -> DataFrame:
    """A row per document: (doc_id, host, path, evidence, host_posterior, path_posterior, quality, kept).

    Null and empty texts are scored by their figures like any other. Null hosts
    and paths are sites of their own; ids may be null or repeated. Labels of
    unknown documents are ignored, null ones too; without labels of both kinds
    the evidence is 0. An empty table gives an empty result.
    """
    model, narrow = fit_quality(docs, labels, **columns)
    model.host, model.path = F.col("host"), F.col("path")
    rows = model.score(narrow, F.col("figures"), [F.col("doc_id"), F.col("host"), F.col("path")])
    return rows.withColumn("kept", F.col("quality") >= threshold)


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **columns) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, columns unchanged; texts are not shuffled."""
    model, _ = fit_quality(docs, labels, **columns)
    text_col = columns.get("text_col", "text")
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keep = fresh(docs, "_figures")
    rows = docs.withColumn(keep, figures(F.col(text_col)))
    scored = model.score(rows, F.col(keep), [own.alias("_row")])
    return scored.filter(F.col("quality") >= threshold).select("_row.*")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
