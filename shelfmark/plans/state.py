"""State tables as immutable snapshots listed in a manifest.

Layout below one root, with a single writer:

    manifest/                               one row per published snapshot
    parts/<table>/version=<v>/bucket=<b>/   the buckets that snapshot ``v`` has changed, never overwritten

The rows of a table are dealt into buckets by a hash of their key. A manifest
row has, for every table, a digest of each of 256 key ranges (the leaves, of
which a bucket holds one or more) and the snapshot that wrote each bucket.
Publishing writes the buckets whose digests differ and refers to the others
again; two snapshots are compared by their digests first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Collection as Some
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.fingerprint import row_hash
from shelfmark.operators.counts import count_deltas, count_message
from shelfmark.operators.upsert import require_keys, upsert
from shelfmark.schemas import STATE_TABLES
from shelfmark.session import drop_path, empty, list_names, path_exists

LEAVES = 256
# Rows of a bucket, about; a table has a power of two of buckets, up to one per leaf.
BUCKET_ROWS = 100_000

_TREE = "struct<buckets: int, written: map<int, bigint>, leaves: map<int, struct<n: bigint, total: string, mixed: bigint>>>"
_MANIFEST = (
    "version bigint not null, snapshot_id string not null, created_at string not null, fingerprint string not null,"
    f" message string, counts map<string, bigint> not null, trees map<string, {_TREE}> not null"
)

Digest = tuple[int, int, int]


@dataclass(frozen=True)
class Tree:
    """``written``: the snapshot of each bucket that has rows. ``leaves``: rows, sum and xor of their hashes by leaf."""

    buckets: int
    written: dict[int, int]
    leaves: dict[int, Digest]

    @staticmethod
    def of(row: Row | None, table: str) -> Tree:
        stored = row.trees.get(table) if row is not None else None
        if stored is None:
            return Tree(1, {}, {})
        return Tree(stored.buckets, dict(stored.written), {i: (d.n, int(d.total), d.mixed) for i, d in stored.leaves.items()})

    @property
    def n(self) -> int:
        return sum(d[0] for d in self.leaves.values())

    def fingerprint(self) -> str:
        total, mixed = sum(d[1] for d in self.leaves.values()), reduce(lambda a, d: a ^ d[2], self.leaves.values(), 0)
        return hashlib.md5(f"{self.n}:{total}:{mixed}".encode()).hexdigest()

    def changed(self, other: Tree) -> set[int]:
        """Leaves that differ."""
        return {i for i in {*self.leaves, *other.leaves} if self.leaves.get(i) != other.leaves.get(i)}

    def row(self) -> tuple:
        return self.buckets, self.written, {i: (n, str(total), mixed) for i, (n, total, mixed) in self.leaves.items()}


def _leaf(keys: Some[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(LEAVES)).cast("int")


@dataclass(frozen=True)
class Published:
    changed: bool
    snapshot_id: str
    message: str | None


def state_name(prefix: str, collection: str) -> str:
    """One state per point collection."""
    return f"{prefix}__{collection}"


class StateStore:
    def __init__(self, spark: SparkSession, root: str, tables: Mapping = STATE_TABLES, bucket_rows: int = BUCKET_ROWS) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.tables = dict(tables)
        self.bucket_rows = bucket_rows

    def _manifest_path(self) -> str:
        return f"{self.root}/manifest"

    def _part(self, table: str, version: int) -> str:
        return f"{self.root}/parts/{table}/version={version}"

    def manifest(self) -> DataFrame:
        """All published snapshots."""
        if not path_exists(self.spark, self._manifest_path()):
            return empty(self.spark, _MANIFEST)
        return self.spark.read.schema(_MANIFEST).parquet(self._manifest_path())

    def latest(self) -> Row | None:
        """Manifest row of the newest snapshot, or None before the first one."""
        found = self.manifest().orderBy(F.col("version").desc()).limit(1).collect()
        return found[0] if found else None

    def exists(self) -> bool:
        return self.latest() is not None

    def _snapshot(self, snapshot_id: str | None) -> Row | None:
        if snapshot_id is None:
            return self.latest()
        found = self.manifest().filter(F.col("snapshot_id") == snapshot_id).collect()
        if not found:
            raise ValueError(f"no snapshot {snapshot_id} below {self.root}")
        return found[0]

    def _rows(self, table: str, tree: Tree, buckets: Some[int] | None = None) -> DataFrame:
        """Rows of a table, or of some of its buckets; no other files are read."""
        schema, _ = self.tables[table]
        paths = [f"{self._part(table, v)}/bucket={b}" for b, v in sorted(tree.written.items()) if buckets is None or b in buckets]
        return self.spark.read.schema(schema).parquet(*paths) if paths else empty(self.spark, schema)

    def read(self, snapshot_id: str | None = None) -> dict[str, DataFrame]:
        """Tables of one snapshot, by default the newest; empty tables when there is none."""
        row = self._snapshot(snapshot_id)
        return {name: self._rows(name, Tree.of(row, name)) for name in self.tables}

    def diff(self, table: str, before: str, after: str | None = None) -> DataFrame:
        """Keys of the table with ``change``: added, removed or changed from one snapshot to another (the newest).

        Only buckets with leaves whose digests differ are read.
        """
        _, keys = self.tables[table]
        old, new = (Tree.of(self._snapshot(i), table) for i in (before, after))
        leaves = old.changed(new)

        def side(tree: Tree, name: str) -> DataFrame:
            rows = self._rows(table, tree, {i % tree.buckets for i in leaves})
            return rows.filter(_leaf(keys).isin(sorted(leaves)) if leaves else F.lit(False)).select(*keys, row_hash(rows).alias(name))

        both = side(old, "_old").join(side(new, "_new"), list(keys), "full")
        change = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").otherwise("changed")
        differs = ~F.col("_old").eqNullSafe(F.col("_new"))
        return both.filter(differs).select(*keys, change.alias("change"))

    def init(self) -> bool:
        """Publish empty tables unless a snapshot exists; True when it did so."""
        if self.exists():
            return False
        self.publish(self.read(), lead="Created state tables")
        return True

    def counts(self) -> DataFrame:
        """``table, n`` of the newest snapshot, taken from the manifest."""
        newest = self.latest()
        known = newest.counts if newest else {}
        rows = [(name, int(known.get(name, 0)), i) for i, name in enumerate(self.tables)]
        return self.spark.createDataFrame(rows, "table string, n bigint, position int")

    def checksum(self) -> str | None:
        """Content fingerprint of the newest snapshot."""
        newest = self.latest()
        return newest.fingerprint if newest else None

    def publish(
        self,
        tables: Mapping[str, DataFrame],
        baseline: DataFrame | None = None,
        lead: str = "Updated state tables",
        now: datetime | None = None,
    ) -> Published:
        """List a snapshot of whole ``tables`` in the manifest if its content is new; only changed buckets are written."""
        return self._commit({name: (tables[name], None) for name in self.tables}, baseline, lead, now)

    def update(
        self,
        changes: Mapping[str, DataFrame],
        baseline: DataFrame | None = None,
        lead: str = "Updated state tables",
        now: datetime | None = None,
    ) -> Published:
        """The newest snapshot with the rows of ``changes`` put in by key (unique in each table).

        Reads and writes the buckets of these keys alone.
        """
        newest = self.latest()
        given: dict[str, tuple[DataFrame, set[int] | None]] = {}
        for name, delta in changes.items():
            _, keys = self.tables[name]
            tree = Tree.of(newest, name)
            leaves = delta.select(_leaf(keys).alias("leaf")).distinct().collect()  # 256 numbers at most
            touched = {r.leaf % tree.buckets for r in leaves}
            if touched:
                given[name] = upsert(self._rows(name, tree, touched), delta, keys), touched
        return self._commit(given, baseline, lead, now)

    def _digests(self, given: Mapping[str, DataFrame]) -> dict[str, dict[int, Digest]]:
        """Digests by leaf of each table: at most 256 rows each."""
        out: dict[str, dict[int, Digest]] = {name: {} for name in given}
        parts = [
            df.select(F.lit(name).alias("table"), _leaf(self.tables[name][1]).alias("leaf"), row_hash(df).alias("h"))
            for name, df in given.items()
        ]
        if parts:
            summed = reduce(DataFrame.unionByName, parts).groupBy("table", "leaf").agg(
                F.count("*").alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("total"), F.bit_xor("h").alias("mixed")
            )
            for r in summed.collect():
                out[r.table][r.leaf] = r.n, int(r.total), r.mixed
        return out

    def _size(self, n: int, former: int) -> int:
        """Buckets of a table with ``n`` rows; they only become more."""
        wanted = 1
        while wanted < LEAVES and wanted * self.bucket_rows < n:
            wanted *= 2
        return max(wanted, former)

    def _commit(
        self, given: Mapping[str, tuple[DataFrame, set[int] | None]], baseline: DataFrame | None, lead: str, now: datetime | None
    ) -> Published:
        """``given`` has whole tables, or rows of the named buckets. The tables are computed once."""
        newest = self.latest()
        version = (newest.version if newest else 0) + 1
        moment = now or datetime.now(timezone.utc)
        snapshot_id = f"{moment.strftime('%Y%m%dT%H%M%SZ')}-{version:06d}"
        trees = {name: Tree.of(newest, name) for name in self.tables}
        held: dict[str, DataFrame] = {}
        try:
            for name, (df, _) in given.items():
                schema, keys = self.tables[name]
                held[name] = require_keys(df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]), keys).persist()
            for name, found in self._digests(held).items():
                trees[name] = self._written(name, trees[name], held[name], found, given[name][1], version)
        finally:
            for df in held.values():
                df.unpersist()
        fingerprint = ";".join(f"{name}={trees[name].fingerprint()}" for name in self.tables)
        if newest is not None and newest.fingerprint == fingerprint:
            return Published(False, newest.snapshot_id, None)
        counts = {name: trees[name].n for name in self.tables}
        current = self.spark.createDataFrame(
            [(name, counts[name], i) for i, name in enumerate(self.tables)], "table string, n bigint, position int"
        )
        message = count_message(count_deltas(current, baseline), lead).collect()[0].message
        row = (version, snapshot_id, moment.isoformat(), fingerprint, message, counts, {name: t.row() for name, t in trees.items()})
        self.spark.createDataFrame([row], _MANIFEST).coalesce(1).write.mode("append").parquet(self._manifest_path())
        return Published(True, snapshot_id, message)

    def _written(
        self, name: str, former: Tree, rows: DataFrame, found: dict[int, Digest], scope: set[int] | None, version: int
    ) -> Tree:
        """The tree of a table after its changed buckets have been written."""
        leaves = found if scope is None else {i: d for i, d in former.leaves.items() if i % former.buckets not in scope} | found
        buckets = self._size(sum(d[0] for d in leaves.values()), former.buckets)
        if buckets != former.buckets:
            changed = {i % buckets for i in {*leaves, *former.leaves}}
            if scope is not None:  # all rows move to other buckets
                rows = rows.unionByName(self._rows(name, former, {*former.written} - scope))
        else:
            changed = {i % buckets for i in Tree(buckets, {}, leaves).changed(former)}
        there = {i % buckets for i in leaves}
        if new := sorted(changed & there):
            keys = self.tables[name][1]
            dealt = rows.withColumn("bucket", _leaf(keys) % buckets)
            if buckets > 1:
                dealt = dealt.filter(F.col("bucket").isin(new)).repartition("bucket")
            dealt.write.mode("overwrite").partitionBy("bucket").parquet(self._part(name, version))
        return Tree(buckets, {b: version if b in changed else former.written[b] for b in there}, leaves)

    def prune(self, keep: int) -> int:
        """Delete what only snapshots before the newest ``keep`` refer to; the manifest still lists them. Returns how many lost parts."""
        if keep < 1:
            raise ValueError("at least the newest snapshot stays")
        snapshots = self.manifest().orderBy(F.col("version").desc()).collect()
        gone: set[int] = set()
        for name in self.tables:
            wanted = {(v, b) for row in snapshots[:keep] for b, v in Tree.of(row, name).written.items()}
            for row in snapshots[keep:]:
                for part in list_names(self.spark, self._part(name, row.version)):
                    if part.startswith("bucket=") and (row.version, int(part.removeprefix("bucket="))) not in wanted:
                        drop_path(self.spark, f"{self._part(name, row.version)}/{part}")
                        gone.add(row.version)
        return len(gone)
