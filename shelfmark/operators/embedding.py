"""Text -> vector."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator, Sequence
from itertools import chain
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.text import word_text


# Texts that are Python strings at a time, about.
SLICE_TEXTS = 256

_VECTOR = pa.list_(pa.float32())


class Embedder(Protocol):
    """What a model has to offer. ``embed`` runs inside Spark tasks."""

    dim: int

    def prepare(self, text: Column) -> Column:
        """Spark-side normalisation of the text, before it goes to ``embed``."""

    def embed(self, texts: Sequence[str]) -> np.ndarray:
        """Vectors of shape ``(len(texts), dim)``."""

    def embed_windows(self, sentences: Sequence[str], buffer_size: int) -> np.ndarray:
        """Vectors of every sentence taken together with its neighbours."""


def windows(sentences: Sequence[str], buffer_size: int) -> Iterator[str]:
    """Each sentence joined with up to ``buffer_size`` neighbours on both sides."""
    for i in range(len(sentences)):
        yield " ".join(sentences[max(0, i - buffer_size) : i + buffer_size + 1])


class _Buckets(dict):
    """The bucket of each word seen; worked out by being asked for."""

    def __init__(self, dim: int) -> None:
        super().__init__()
        self.dim = dim

    def __missing__(self, word: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        found = self[word] = int.from_bytes(hashlib.md5(word.encode()).digest()[:4], "big") % self.dim
        return found


class HashedEmbedder:
    """Deterministic bag of words: word counts in md5 buckets, scaled to unit length."""

    def __init__(self, dim: int = 64) -> None:
        if dim <= 0:
            raise ValueError("dim must be positive")
        self.dim = dim
        self._buckets = _Buckets(dim)

    def __getstate__(self) -> dict:
        return {"dim": self.dim}

    def __setstate__(self, state: dict) -> None:
        self.__init__(state["dim"])

    def prepare(self, text: Column) -> Column:
        return word_text(text)

    def counts(self, texts: Sequence[str]) -> np.ndarray:
        """Word counts per bucket of prepared texts."""
        words = [text.split() if text else [] for text in texts]
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        rows = np.repeat(np.arange(len(words)) * self.dim, sizes)
        cells = np.fromiter(map(self._buckets.__getitem__, chain.from_iterable(words)), dtype=np.int64, count=int(sizes.sum()))
        counted = np.bincount(rows + cells, minlength=len(words) * self.dim)
        return counted.reshape(len(words), self.dim).astype(float)

    def embed(self, texts: Sequence[str]) -> np.ndarray:
        return _unit(self.counts(texts))

    def embed_windows(self, sentences: Sequence[str], buffer_size: int) -> np.ndarray:
        # Counts add up, so a window is a difference of running sums.
        n = len(sentences)
        running = np.zeros((n + 1, self.dim))
        np.cumsum(self.counts(sentences), axis=0, out=running[1:])
        at = np.arange(n)
        return _unit(running[np.minimum(at + buffer_size + 1, n)] - running[np.maximum(at - buffer_size, 0)])


_MODELS: dict[str, object] = {}


class ModelEmbedder:
    """A user model: ``factory()`` gives a callable ``list[str] -> vectors``.

    The factory runs once per Python worker, on first use. Without ``dim`` it
    also runs here, once, to find the vector size from one short text.
    """

    def __init__(
        self, factory: Callable[[], Callable[[list[str]], object]], dim: int | None = None, batch_size: int = 256
    ) -> None:
        self.dim = len(np.asarray(factory()(["dimension probe"]))[0]) if dim is None else dim
        self.batch_size = batch_size
        self._factory = factory
        self._key = uuid.uuid4().hex

    def prepare(self, text: Column) -> Column:
        return text

    def load(self) -> None:
        """Build the model, if this worker has not yet."""
        self._model()

    def _model(self):
        if self._key not in _MODELS:
            _MODELS[self._key] = self._factory()
        return _MODELS[self._key]

    def embed(self, texts: Sequence[str]) -> np.ndarray:
        if not len(texts):
            return np.zeros((0, self.dim))
        model = self._model()
        parts = [
            np.asarray(model([t or "" for t in texts[at : at + self.batch_size]]), dtype=float)
            for at in range(0, len(texts), self.batch_size)
        ]
        vectors = np.concatenate(parts).reshape(len(texts), -1)
        if vectors.shape[1] != self.dim:
            raise ValueError(f"model gave vectors of size {vectors.shape[1]}, expected {self.dim}")
        return vectors

    def embed_windows(self, sentences: Sequence[str], buffer_size: int) -> np.ndarray:
        # Window texts overlap, so only one model batch of them is held at a time.
        parts, batch = [], []
        for text in windows(sentences, buffer_size):
            batch.append(text)
            if len(batch) == self.batch_size:
                parts.append(self.embed(batch))
                batch = []
        if batch or not parts:
            parts.append(self.embed(batch))
        return np.concatenate(parts)


def row_embedder(embed_one: Callable[[str], Sequence[float]], dim: int | None = None) -> ModelEmbedder:
    """A model given as a function of one text."""
    return ModelEmbedder(lambda: lambda texts: [embed_one(t) for t in texts], dim)


def _unit(vectors: np.ndarray) -> np.ndarray:
    lengths = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return np.divide(vectors, lengths, out=np.zeros_like(vectors), where=lengths > 0)


def _slices(texts: pa.Array, embedder: Embedder) -> Iterator[list[str]]:
    """Texts of an Arrow batch in whole model batches, so that few of them are Python strings at a time."""
    size = getattr(embedder, "batch_size", None) or SLICE_TEXTS
    step = size * -(-SLICE_TEXTS // size)
    for at in range(0, len(texts), step):
        yield [t or "" for t in texts.slice(at, step).to_pylist()]


def _lists(vectors: np.ndarray) -> pa.Array:
    ends = np.arange(0, vectors.size + 1, vectors.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(vectors.astype(np.float32).ravel()))


def embed_column(text: Column, embedder: Embedder) -> Column:
    """``array<float>`` vectors of a text column; Arrow batches, one model per worker."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [_lists(embedder.embed(some)) for some in _slices(texts, embedder)]
            yield pa.concat_arrays(parts) if parts else pa.array([], _VECTOR)

    return F.arrow_udf(run, "array<float>")(embedder.prepare(text))


def embed_column_safely(text: Column, embedder: Embedder) -> Column:
    """``struct<vector, error>``: a text the model rejects gets an error instead of failing the job."""

    def isolated(texts: list[str]) -> list[tuple]:
        """Halves a batch until the offending texts stand alone."""
        try:
            return [(v, None) for v in embedder.embed(texts).astype(np.float32)]
        except Exception as exc:
            if len(texts) == 1:
                return [(None, f"{type(exc).__name__}: {exc}")]
        half = len(texts) // 2
        return isolated(texts[:half]) + isolated(texts[half:])

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            vectors, errors = [pa.array([], _VECTOR)], []
            for some in _slices(texts, embedder):
                found = isolated(some)
                vectors.append(pa.array([v for v, _ in found], _VECTOR))
                errors += [e for _, e in found]
            yield pa.StructArray.from_arrays([pa.concat_arrays(vectors), pa.array(errors, pa.string())], names=["vector", "error"])

    return F.arrow_udf(run, "struct<vector: array<float>, error: string>")(embedder.prepare(text))
