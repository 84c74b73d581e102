"""Vector code compression: codebooks by Lloyd rounds whose members stay where they are.

A vector is cut into parts; each part position has a codebook, and a part is
coded by its nearest entry. The parts are laid out by (position, entry, salt):
that group owns the entry, and the parts in it are its members. In a round the
owners update their entries from their resident members, by sums that tasks add
up before anything is shuffled. Every member then looks for its nearest entry
again, and only parts whose entry changes migrate: the round's shuffle carries
these alone, to a new segment of the layout.

What has been written stays as it is. A part lies in the segment of the round in
which it came to its entry, and is resident there until the first later round
that gives it another one. The codebooks of all rounds are small and go to every
task, so a task tells its residents from those that have left by itself.

All arithmetic is on integers: exact in doubles while the components are small
enough, by Python integers beyond that.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.common import read
from shelfmark.operators.joins import narrow_join
from shelfmark.session import Steps, empty, stage

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
# Members of an owner's group, at most on average.
GROUP = 1024
# Sums travel as limbs of so many bits, so that adding them up cannot overflow.
LIMB = 32
_COUNT = -1
_LARGEST = (1 << 63) - 1

Books = np.ndarray
"""Entries by (position, entry, place): doubles that are integers, or Python integers."""


def _exact(most: float, width: int) -> bool:
    """Whether squared distances of integers up to ``most`` are exact in doubles, step by step."""
    return 4 * max(1, width) * most * most < 2**53


def floors(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of finite doubles: as doubles where all are exact, else as Python integers."""
    if not values.size or np.abs(values).max() * scale < 2**38:
        return np.floor(values * scale)
    whole = [int(v) * scale if abs(v) >= 2**53 else int(np.floor(v * scale)) for v in values.ravel().tolist()]
    return np.array(whole, dtype=object).reshape(values.shape)


def _widest(a: np.ndarray) -> float:
    return float(max(abs(v) for v in (a.max(), a.min()))) if a.size else 0.0


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest entry of each part; ties go to the lower index."""
    if not _exact(max(_widest(parts), _widest(book)), parts.shape[1]):
        parts, book = (np.vectorize(int, otypes=[object])(a) if a.size else a.astype(object) for a in (parts, book))
    squared = (parts * parts).sum(axis=1)[:, None] - 2 * (parts @ book.T) + (book * book).sum(axis=1)[None, :]
    entry = squared.argmin(axis=1)
    return entry.astype(np.int64), squared[np.arange(len(parts)), entry]


def _limbs(value: int) -> list[int]:
    """``value`` as limbs of ``LIMB`` bits with its sign, lowest first."""
    sign, rest, out = (-1 if value < 0 else 1), abs(value), []
    while rest:
        out.append(sign * (rest & ((1 << LIMB) - 1)))
        rest >>= LIMB
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), width)


def _lists(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(matrix.ravel(), kind))


class _Members:
    """Reads members of the layout, given the codebooks of the rounds so far."""

    def __init__(self, books: list[Books], width: int, scale: int) -> None:
        self.books, self.width, self.scale = books, width, scale

    def groups(self, batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(position, rows, entries, parts) of the residents under all codebooks but the last one.

        ``rows`` are places in the batch, ``parts`` integers.
        """
        position, entry, born = (batch.column(c).to_numpy() for c in ("position", "entry", "born"))
        raw = _matrix(batch.column("part"), self.width)
        for p, b in {*zip(position.tolist(), born.tolist(), strict=True)}:
            rows = np.flatnonzero((position == p) & (born == b))
            parts = floors(raw[rows], self.scale)
            for later in self.books[b + 1 : -1]:
                stays = nearest(parts, later[p])[0] == entry[rows]
                rows, parts = rows[stays], parts[stays]
            if len(rows):
                yield p, rows, entry[rows], parts

    def movers(self, kind: pa.DataType):
        """Residents that the last codebook gives to another entry."""

        def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            born = len(self.books) - 1
            for batch in batches:
                for p, rows, entry, parts in self.groups(batch):
                    new = nearest(parts, self.books[-1][p])[0]
                    gone = new != entry
                    at = rows[gone]
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("row").take(pa.array(at)),
                            pa.array(np.full(len(at), p, dtype=np.int32)),
                            pa.array(new[gone].astype(np.int32)),
                            pa.array(np.full(len(at), born, dtype=np.int32)),
                            batch.column("part").take(pa.array(at)).cast(pa.list_(kind)),
                        ],
                        names=["row", "position", "entry", "born", "part"],
                    )

        return of

    def sums(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums and counts of the residents of each entry, a task's together."""
        positions, entries, width = self.books[0].shape
        total = np.zeros((positions, entries, width), dtype=object)
        count = np.zeros((positions, entries), dtype=np.int64)
        for batch in batches:
            for p, rows, entry, parts in self.groups(batch):
                # Who has left under the last codebook lies in its own segment.
                born = batch.column("born").to_numpy()[rows[0]]
                if born < len(self.books) - 1:
                    stays = nearest(parts, self.books[-1][p])[0] == entry
                    entry, parts = entry[stays], parts[stays]
                for e in np.unique(entry):
                    mine = parts[entry == e]
                    # Doubles are exact here: at most a batch of integers below 2**38 each.
                    total[p, e] += np.array([int(v) for v in mine.sum(axis=0)], dtype=object)
                    count[p, e] += len(mine)
        out: list[tuple[int, int, int, int, int]] = []
        for p, e in zip(*np.nonzero(count), strict=True):
            for place, value in ((_COUNT, int(count[p, e])), *enumerate(total[p, e])):
                out += [(int(p), int(e), place, i, v) for i, v in enumerate(_limbs(int(value)))]
        columns = [list(c) for c in zip(*out, strict=True)] if out else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [*[pa.array(c, pa.int32()) for c in columns[:4]], pa.array(columns[4], pa.int64())],
            names=["position", "entry", "place", "limb", "value"],
        )

    def coded(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(row, position, entry, distance) of the residents under the last codebook; a distance beyond a long is null."""
        last = self.books[-1]
        for batch in batches:
            for p, rows, entry, parts in self.groups(batch):
                near, distance = nearest(parts, last[p])
                stays = near == entry
                found = [int(d) for d in distance[stays]]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").take(pa.array(rows[stays])),
                        pa.array(np.full(len(found), p, dtype=np.int32)),
                        pa.array(entry[stays].astype(np.int32)),
                        pa.array([d if d <= _LARGEST else None for d in found], pa.int64()),
                    ],
                    names=["row", "position", "entry", "distance"],
                )


def _book(values: np.ndarray) -> Books:
    """Integers as doubles where they are exact, so that products are fast."""
    return values.astype(np.float64) if _exact(_widest(values), values.shape[-1]) else values


def _updated(layout: DataFrame, books: list[Books], width: int, scale: int) -> Books:
    """The entries after the last round's members; unused ones stay. Entries x places rows reach the driver."""
    members = _Members(books, width, scale)
    schema = "position int, entry int, place int, limb int, value long"
    summed = layout.mapInArrow(members.sums, schema).groupBy("position", "entry", "place", "limb").agg(F.sum("value").alias("value"))
    total: dict[tuple[int, int, int], int] = {}
    for r in summed.collect():
        key = (r["position"], r["entry"], r["place"])
        total[key] = total.get(key, 0) + (r["value"] << (LIMB * r["limb"]))
    new = np.vectorize(int, otypes=[object])(books[-1]) if books[-1].size else books[-1].astype(object)
    for p, e, place in np.ndindex(new.shape):
        if n := total.get((p, e, _COUNT)):
            new[p, e, place] = total.get((p, e, place), 0) // n
    return _book(new)


def usable(vector: Column, kind: T.DataType) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    fractions = isinstance(kind, T.FloatType | T.DoubleType)
    bad = lambda x: x.isNull() | (F.isnan(x) | (F.abs(x) == float("inf")) if fractions else F.lit(False))
    return vector.isNotNull() & ~F.exists(vector, bad)


def vector_codes(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> DataFrame:
    """A row per usable vector: (vec_id, code, error, label_error, codebooks_sha256).

    Components become floor(scale * x). Vectors that are null or hold null or
    non-finite components take no part, and neither do vectors whose length is
    not the most frequent one (of equally frequent ones, the longest). A length
    that is no multiple of ``parts`` is filled up with zeros. The codebooks start
    from the ``entries`` smallest ids, null ids last, repeated ids by their
    vectors; with fewer vectors they have fewer entries. Repeated rows count
    each on its own. ``error`` sums the squared distances of a vector's parts,
    ``label_error`` the errors of all vectors with an equal label, nulls
    together; a sum beyond a long is null. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    out = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
    element = vectors.schema[vector_col].dataType.elementType
    plain = element if isinstance(element, T.FloatType) else T.DoubleType()
    kept = stage(
        vectors.filter(usable(F.col(vector_col), element)).select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).cast("bigint").alias("vec_id"),
            F.col(label_col).alias("label"),
            F.col(vector_col).cast(T.ArrayType(plain)).alias("vector"),
        ),
        "vectors",
    )
    lengths = kept.groupBy(F.size("vector").alias("n")).agg(F.count("*").alias("rows"))
    common = lengths.orderBy(F.desc("rows"), F.desc("n")).first()
    if common is None:
        return empty(spark, out)
    length, n_rows = common["n"], common["rows"]
    kept = kept.filter(F.size("vector") == length)
    width = -(-length // parts)

    def cut(matrix: np.ndarray) -> np.ndarray:
        filled = np.zeros((len(matrix), parts * width))
        filled[:, :length] = matrix
        return filled.reshape(len(matrix), parts, width)

    first = kept.orderBy(F.isnull("vec_id"), "vec_id", "vector").limit(entries).select("vector").collect()
    start = np.array([[float(x) for x in r["vector"]] for r in first]).reshape(len(first), length)
    books = [_book(floors(cut(start).transpose(1, 0, 2), scale))]
    kind = pa.float32() if isinstance(plain, T.FloatType) else pa.float64()

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), GROUP):
                batch = whole.slice(at, GROUP)
                raw = cut(_matrix(batch.column("vector"), length))
                for p in range(parts):
                    entry = nearest(floors(raw[:, p], scale), books[0][p])[0]
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("row"),
                            pa.array(np.full(len(batch), p, dtype=np.int32)),
                            pa.array(entry.astype(np.int32)),
                            pa.array(np.zeros(len(batch), dtype=np.int32)),
                            _lists(raw[:, p], kind),
                        ],
                        names=["row", "position", "entry", "born", "part"],
                    )

    salts = -(-n_rows // GROUP)
    schema = f"row long, position int, entry int, born int, part array<{plain.simpleString()}>"
    steps = Steps()
    segments: list[str] = []

    def settle(members: DataFrame) -> None:
        """A new segment of the layout, from parts that come to their owners."""
        salt = F.pmod(F.xxhash64("row"), F.lit(salts))
        path = steps.new_path(spark, "segment")
        members.repartition("position", "entry", salt).write.parquet(path)
        segments.append(path)

    def layout() -> DataFrame:
        return spark.read.schema(schema).parquet(*segments)

    settle(kept.select("row", "vector").mapInArrow(placed, schema))
    for _ in range(rounds):
        new = _updated(layout(), books, width, scale)
        if (new == books[-1]).all():
            break  # nobody moves any more
        books.append(new)
        settle(layout().mapInArrow(_Members(books, width, scale).movers(kind), schema))
    coded = layout().mapInArrow(_Members(books, width, scale).coded, "row long, position int, entry int, distance long")
    digits = [F.max(F.when(F.col("position") == p, F.col("entry"))) for p in range(parts)]
    code = F.concat(*[F.lower(F.lpad(F.hex(d), 2, "0")) for d in digits])
    error = F.when(F.count("distance") == parts, F.try_sum("distance"))
    by_row = coded.groupBy("row").agg(code.alias("code"), error.alias("error"))
    names = kept.select("row", "vec_id", F.isnull("label").alias("_unknown"), F.coalesce(F.col("label").cast("string"), F.lit("")).alias("_label"))
    found = stage(names.join(by_row, "row").drop("row"), "codes")
    steps.release()
    whole = F.when(F.count("error") == F.count("*"), F.try_sum("error"))
    by_label = stage(found.groupBy("_unknown", "_label").agg(whole.alias("label_error")), "label-errors")
    text = ",".join(str(int(v)) for v in books[-1].ravel().tolist())
    joined = narrow_join(found, by_label, ["_unknown", "_label"], ["vec_id"])
    return joined.select(
        "vec_id", "code", "error", "label_error", F.lit(hashlib.sha256(text.encode()).hexdigest()).alias("codebooks_sha256")
    )


def _sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same by plain SQL: every round joins all parts with their codebook."""
    floor_div = "(s - ((s % n) + n) % n) // n"
    square = "list_sum(list_transform(list_zip(p.c, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint"
    nearest_of = (
        f"(select vec_id, position, any_value(p.c) c, min({square} * {entries} + entry) best"
        " from parts p join book_{r} b using (position) group by vec_id, position)"
    )
    steps = [
        "kept as materialized (select vec_id, label, embedding from embeddings where embedding is not null"
        " and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)",
        "parts as materialized (select vec_id, position, list_transform(embedding[position * w + 1 : (position + 1) * w],"
        f" lambda x: floor({scale} * x::double)::bigint) c from (select *, len(embedding) // {parts} w from kept),"
        f" range({parts}) t(position))",
        "book_0 as materialized (select position, entry, c from parts join (select vec_id, row_number() over (order by vec_id) - 1"
        f" entry from kept) using (vec_id) where entry < {entries})",
    ]
    for r in range(rounds):
        steps += [
            f"near_{r} as materialized (select vec_id, position, c, best % {entries} entry from {nearest_of.format(r=r)})",
            f"mean_{r} as (select position, entry, list(({floor_div})::bigint order by place) c from (select position, entry, place,"
            " sum(c[place])::bigint s, count(*) n"
            f" from (select *, unnest(range(1, len(c) + 1)) place from near_{r}) group by position, entry, place) group by position, entry)",
            f"book_{r + 1} as materialized (select b.position, b.entry, coalesce(m.c, b.c) c from book_{r} b"
            f" left join mean_{r} m on b.position = m.position and b.entry = m.entry)",
        ]
    steps += [
        f"coded as materialized (select vec_id, string_agg(lpad(lower(to_hex(best % {entries})), 2, '0'), '' order by position) code,"
        f" sum(best // {entries})::bigint error from {nearest_of.format(r=rounds)} group by vec_id)",
        f"books as (select sha256(string_agg(array_to_string(c, ','), ',' order by position, entry)) h from book_{rounds})",
    ]
    return (
        f"with {', '.join(steps)} select vec_id, code, error, (sum(error) over (partition by label))::bigint label_error,"
        " h codebooks_sha256 from coded join kept using (vec_id), books"
    )


SQL = _sql()


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(read(spark, sf_dir, "embeddings"))
