"""A table unique by key that is changed by small immutable deltas.

The rows lie in version folders, each partitioned by a hash bucket of the key. An upsert never
touches an old file. It writes, under a new version,

- ``rows``: the arriving rows,
- ``gone``: key and version of the stored rows that they replace,
- ``index``: for large versions, per file a bit table of its keys' hashes, by which a later upsert
  opens only files that may hold one of its keys,

and then publishes a manifest, the list of live (bucket, version) pairs. Publishing is the
commit: a run that dies before it leaves the old state as it was, and its folders are removed
by the next commit. Readers keep the manifest they opened the table with; folders leave only
``keep_seconds`` after they were dropped.

A read is the rows of all live pairs without the gone ones; buckets in which nothing was
replaced are scanned as they are. When the deltas of a bucket pass a share of its base, the
bucket is folded into a new base; when they are merely many, they are folded into one delta.
A load that is large enough to make all its buckets due is folded in as it is written: arriving
and stored rows meet in one shuffle, and what would be replaced at once is never marked.
"""

from __future__ import annotations

import math
import time
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.operators.dedup import latest_version
from terrace.session import TABLE_CODEC
from terrace.sources.paths import children, delete, exists
from terrace.sources.versioned import is_published, publish, read_current
from terrace.staging import staged

VERSION_COLUMN = "delta_version"
_BUCKET_PREFIX = "bucket_of_"
_SUPERSEDED = "superseded_version"
_ROWS, _GONE, _INDEX = "rows", "gone", "index"
_MANIFEST_SCHEMA = (
    "commit long, layout string, bucket int, version string, rows long, gone long, indexed boolean, "
    "dropped_at double"
)

# Bits of a file's table of keys: the least that gives a key sixteen, or the greatest.
_TABLE_BITS = tuple(1 << n for n in (15, 18, 21, 24, 27))
_BITS_PER_KEY = 16

# Rows of a bucket that are sorted by key and written in one piece, about.
_SHARE_ROWS = 1 << 20
# Parts of a bucket's keys that are counted, to see one in which few keys have very many rows.
_FINE = 64
_AGE, _SHARE, _RANK = "_age", "_share", "_rank"


@dataclass(frozen=True)
class Part:
    """One version's share of a bucket: its rows, and the older rows that it replaces."""

    bucket: int
    version: str
    rows: int
    gone: int
    # Whether its files have tables of keys; small versions are read instead.
    indexed: bool
    # When a fold took its place, in seconds; None for a live part.
    dropped_at: float | None = None


@dataclass(frozen=True)
class Upserted:
    """What an upsert did: the days of the rows it replaced, its version (None if nothing arrived),
    and the numbers of the last commit before and after it."""

    days: list
    version: str | None
    before: int
    after: int


class KeyedTable:
    """See the module. One writer at a time, any number of readers.

    ``fold_share`` is the share of a bucket's base that its deltas may reach, in rows arrived and
    replaced, once these are ``fold_rows`` or more; ``max_deltas`` is the number of deltas. Versions
    of ``index_rows`` rows or more are indexed. Up to ``index_keys`` arriving keys are looked
    up by the index; with more, and in versions without, the key column of their buckets is read.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str,
        buckets: int,
        cluster_by: Sequence[str] = (),
        schema: T.StructType | None = None,
        fold_share: float = 0.5,
        max_deltas: int = 8,
        fold_rows: int = 10_000,
        index_rows: int = 10_000_000,
        index_keys: int = 1_000_000,
        keep_seconds: float = 3600,
    ):
        self.spark = spark
        self.path = path
        self.key = key
        self.buckets = buckets
        self.cluster_by = list(cluster_by)
        # With a schema the table can be read before it holds rows, and without a footer scan.
        self.schema = schema
        self.fold_share = fold_share
        self.max_deltas = max_deltas
        self.fold_rows = fold_rows
        self.index_rows = index_rows
        self.index_keys = index_keys
        self.keep_seconds = keep_seconds
        # The column name carries the bucket count: opening a table with another one fails.
        self.bucket_column = f"{_BUCKET_PREFIX}{buckets}"

    # --- manifest ---------------------------------------------------------------------

    @property
    def _manifest(self) -> str:
        return f"{self.path}/manifest"

    def _parts(self) -> tuple[int, list[Part]]:
        """(number of the last commit, its parts): at most a few rows per bucket."""
        if not is_published(self.spark, self._manifest):
            return 0, []
        rows = read_current(self.spark, self._manifest).collect()
        for row in rows:
            if row["layout"] != self.bucket_column:
                raise ValueError(f"{self.path} is laid out as {row['layout']}, not {self.bucket_column}")
        parts = [
            Part(r["bucket"], r["version"], r["rows"], r["gone"], r["indexed"], r["dropped_at"]) for r in rows
        ]
        return max((r["commit"] for r in rows), default=0), parts

    def _live(self) -> list[Part]:
        return [p for p in self._parts()[1] if p.dropped_at is None]

    def commit_number(self) -> int:
        """Grows by one with each commit; 0 for a table that was never written."""
        return self._parts()[0]

    def exists(self) -> bool:
        """Whether rows were ever written; an upsert of nothing does not make a table."""
        return bool(self._live())

    def _commit(self, number: int, parts: Iterable[Part]) -> None:
        """Publish the parts, then remove folders that no reader can be using."""
        expired = time.time() - self.keep_seconds
        kept = [p for p in parts if p.dropped_at is None or p.dropped_at > expired]
        data = [
            (number, self.bucket_column, p.bucket, p.version, p.rows, p.gone, p.indexed, p.dropped_at)
            for p in kept
        ]
        publish(self.spark.createDataFrame(data, _MANIFEST_SCHEMA).coalesce(1), self._manifest, keep_seconds=0)
        named = {f"{VERSION_COLUMN}={p.version}" for p in kept}
        for kind in (_ROWS, _GONE, _INDEX):
            for folder in children(self.spark, f"{self.path}/{kind}"):
                if folder not in named:
                    delete(self.spark, f"{self.path}/{kind}/{folder}")

    # --- reading ----------------------------------------------------------------------

    def _folder(self, kind: str, version: str) -> str:
        return f"{self.path}/{kind}/{VERSION_COLUMN}={version}"

    def _open(self, kind: str, paths: Sequence[str], schema: T.StructType | None) -> DataFrame:
        """Files of one kind, with bucket and version as columns."""
        reader = self.spark.read.option("basePath", f"{self.path}/{kind}")
        if schema is not None:
            version = T.StructField(VERSION_COLUMN, T.StringType())
            bucket = T.StructField(self.bucket_column, T.IntegerType())
            reader = reader.schema(T.StructType([*schema.fields, version, bucket]))
        return reader.parquet(*paths)

    def _of_parts(self, kind: str, parts: Sequence[Part], schema: T.StructType | None = None) -> DataFrame:
        buckets: dict[str, set[int]] = defaultdict(set)
        for part in parts:
            buckets[part.version].add(part.bucket)
        versions: dict[frozenset[int], list[str]] = defaultdict(list)
        for version, held in buckets.items():
            versions[frozenset(held)].append(version)
        files = self._open(kind, [self._folder(kind, v) for v in sorted(buckets)], schema)
        # Conditions on partition columns: they choose folders and read nothing.
        each = [
            F.col(VERSION_COLUMN).isin(names) & F.col(self.bucket_column).isin(sorted(held))
            for held, names in versions.items()
        ]
        return files.where(reduce(Column.__or__, each))

    def _gone_of(self, parts: Sequence[Part]) -> DataFrame | None:
        """(key, superseded version, bucket, ...) named by the parts; None if there are none."""
        replacing = [p for p in parts if p.gone]
        return self._of_parts(_GONE, replacing) if replacing else None

    def _current(self, stored: DataFrame, parts: Sequence[Part]) -> DataFrame:
        """``stored``, rows of these parts, without those that later parts replace."""
        gone = self._gone_of(parts)
        if gone is None:
            return stored
        marks = gone.select(
            self.bucket_column, self.key, F.col(_SUPERSEDED).alias(VERSION_COLUMN)
        )
        touched = F.col(self.bucket_column).isin(sorted({p.bucket for p in parts if p.gone}))
        kept = stored.where(touched).join(marks, [self.bucket_column, VERSION_COLUMN, self.key], "left_anti")
        return stored.where(~touched).unionByName(kept)

    def read(self) -> DataFrame:
        live = self._live()
        if not live:
            if self.schema is None:
                raise FileNotFoundError(f"no rows below {self.path}")
            return self.spark.createDataFrame([], self.schema)
        stored = self._of_parts(_ROWS, live, self.schema)
        return self._current(stored, live).drop(self.bucket_column, VERSION_COLUMN)

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The stored rows of the keys (one column, named like the key), by way of the index."""
        live = self._live()
        if not live:
            return self.read()
        found = self._holding(self._bucketed(keys.select(self.key)), live)
        return found.drop(self.bucket_column, VERSION_COLUMN)

    # --- key index ----------------------------------------------------------------------

    def _bucketed(self, df: DataFrame) -> DataFrame:
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        return df.withColumn(self.bucket_column, bucket)

    def _bit(self, bits: Column) -> Column:
        """A key's place among the bits of a table, from 1 on; independent of its bucket."""
        return F.pmod(F.xxhash64(self.key, F.lit(1)), bits) + 1

    def _write_index(self, version: str) -> None:
        stored = self._open(_ROWS, [self._folder(_ROWS, version)], self.schema)
        keys = stored.select(self.key, self.bucket_column, F.col("_metadata.file_name").alias("file"))
        wanted = F.count(F.lit(1)) * _BITS_PER_KEY
        bits = F.coalesce(*[F.when(wanted <= n, n) for n in _TABLE_BITS], F.lit(_TABLE_BITS[-1]))
        files = keys.groupBy(self.bucket_column, "file").agg(bits.cast("long").alias("bits"))
        # A row per file: the keys stay where they are read.
        placed = keys.join(F.broadcast(files), [self.bucket_column, "file"]).withColumn("bit", self._bit(F.col("bits")))
        # The keys are sorted by these columns: the one that tells most of them apart stands first.
        tables = placed.groupBy(
            F.bitmap_bucket_number("bit").alias("chunk"), "bits", self.bucket_column, "file"
        ).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("keys"))
        self._write(tables, _INDEX, version)

    def _files_that_may_hold(self, keys: DataFrame, live: Sequence[Part]) -> list[str]:
        """Files in which the index does not rule out all of the keys: never more than there are."""
        sizes = F.explode(F.array(*[F.lit(n).cast("long") for n in _TABLE_BITS])).alias("bits")
        probes = keys.select(self.key, self.bucket_column, sizes).withColumn("bit", self._bit(F.col("bits")))
        probes = probes.select(
            self.bucket_column, "bits",
            F.bitmap_bucket_number("bit").alias("chunk"), F.bitmap_bit_position("bit").alias("place"),
        )
        byte = F.expr("cast(conv(hex(substring(keys, cast(place div 8 as int) + 1, 1)), 16, 10) as int)")
        is_set = F.expr("cast(place % 8 as int)")
        met = self._of_parts(_INDEX, live).join(probes, [self.bucket_column, "bits", "chunk"])
        held = met.where(F.call_function("shiftright", byte, is_set).bitwiseAND(1) == 1)
        found = held.select(VERSION_COLUMN, self.bucket_column, "file").distinct().collect()
        return [
            f"{self._folder(_ROWS, r[0])}/{self.bucket_column}={r[1]}/{r[2]}" for r in found
        ]

    def _holding(self, keys: DataFrame, live: Sequence[Part], columns: Sequence[str] | None = None) -> DataFrame:
        """Live rows with one of the keys, with bucket and version."""
        count, buckets = keys.agg(F.count(F.lit(1)), F.collect_set(self.bucket_column)).first()
        asked = set(buckets)
        inside = [p for p in live if p.bucket in asked]
        by_index = [p for p in inside if p.indexed and count <= self.index_keys]
        read_whole = [p for p in inside if p not in set(by_index)]
        files = self._files_that_may_hold(keys, by_index) if by_index else []
        found = [self._of_parts(_ROWS, read_whole, self.schema)] if read_whole else []
        found += [self._open(_ROWS, files, self.schema)] if files else []
        # Without a file that may hold a key: no rows, of the table's columns.
        none = [] if found else [self._of_parts(_ROWS, live[:1], self.schema).where(F.lit(False))]
        stored = reduce(DataFrame.unionByName, [*found, *none])
        if columns is not None:
            stored = stored.select(*columns, self.bucket_column, VERSION_COLUMN)
        if not found:
            return stored
        return self._current(stored.join(keys.select(self.key), self.key, "left_semi"), inside)

    # --- writing ----------------------------------------------------------------------

    def _write(self, df: DataFrame, kind: str, version: str) -> None:
        """One shuffle that brings each bucket together and splits the large ones. Sorted files let
        later date filters skip row groups."""
        order = self.cluster_by if kind == _ROWS else []
        (
            df.hint("rebalance", self.bucket_column)
            .sortWithinPartitions(self.bucket_column, *order)
            .write.partitionBy(self.bucket_column)
            .option("compression", TABLE_CODEC)
            .parquet(self._folder(kind, version))
        )

    def upsert(self, changes: DataFrame, newest_first: Sequence[str] = ()) -> None:
        """Insert new keys and replace known ones; never deletes. Safe to run again.

        ``newest_first`` names the version columns when ``changes`` may repeat a key.
        """
        if newest_first:
            if self._upsert_and_fold(changes, newest_first):
                return
            changes = latest_version(changes, [self.key], newest_first)
        with staged(changes, "changes") as incoming:
            self.upsert_stored(incoming)

    def _dealt(self, df: DataFrame, total: int) -> DataFrame:
        """Rows of a bucket in shares by key, each whole in one task, of about ``_SHARE_ROWS``."""
        shares = math.ceil(total / self.buckets / _SHARE_ROWS)
        share = F.pmod(F.xxhash64(self.key, F.lit(2)), F.lit(max(shares, 1))).cast("int")
        return df.withColumn(_SHARE, share).repartition(self.bucket_column, _SHARE)

    def _aged(self, stored: DataFrame, parts: Sequence[Part]) -> DataFrame:
        """A small number in place of the version: the later, the greater."""
        versions = F.array(*[F.lit(v) for v in sorted({p.version for p in parts})])
        age = F.array_position(versions, F.col(VERSION_COLUMN)).cast("int")
        return stored.withColumn(_AGE, age).drop(VERSION_COLUMN)

    def _newest(self, dealt: DataFrame) -> DataFrame:
        """Of each key the rows of its last version, which an upsert or a fold left as the valid ones."""
        window = Window.partitionBy(self.bucket_column, _SHARE, self.key).orderBy(F.desc(_AGE))
        return dealt.withColumn(_RANK, F.rank().over(window)).where(F.col(_RANK) == 1).drop(_RANK)

    def _counted(self, version: str) -> dict[int, int]:
        """Rows of a written version by bucket."""
        return _counts(self._open(_ROWS, [self._folder(_ROWS, version)], self.schema), self.bucket_column)

    def _write_dealt(self, df: DataFrame, version: str) -> None:
        ordered = df.drop(_AGE, _SHARE).sortWithinPartitions(self.bucket_column, *self.cluster_by)
        writer = ordered.write.partitionBy(self.bucket_column).option("compression", TABLE_CODEC)
        writer.parquet(self._folder(_ROWS, version))

    def _upsert_and_fold(self, changes: DataFrame, newest_first: Sequence[str]) -> bool:
        """Upsert into buckets that are empty or that the load makes due for folding, by one shuffle of
        arriving and stored rows. False if there are others, or if few keys have very many of the rows, which
        one task would get: then nothing was done."""
        b = self.bucket_column
        incoming = self._bucketed(changes)
        fine = F.pmod(F.xxhash64(self.key, F.lit(2)), F.lit(_FINE)).alias("fine")
        missing = F.count_if(F.col(self.key).isNull()).alias("missing")
        counted = incoming.groupBy(b, fine).agg(F.count(F.lit(1)).alias("n"), missing)
        # One row per bucket reaches the driver.
        sizes = counted.groupBy(b).agg(F.sum("n"), F.max("n"), F.sum("missing")).collect()
        if any(r[3] for r in sizes):
            raise ValueError(f"rows without {self.key} cannot be upserted")
        if not sizes:
            return True
        if any(r[2] > 4 * r[1] / _FINE + _SHARE_ROWS for r in sizes):
            return False
        number, parts = self._parts()
        version = _new_version()
        arriving = [Part(r[0], version, r[1], 0, False) for r in sizes]
        asked = {p.bucket for p in arriving}
        held = [p for p in parts if p.dropped_at is None and p.bucket in asked]
        own = _by_bucket(held)
        if not all(self._large(own[new.bucket], new.rows) for new in arriving):
            return False
        rows = incoming.withColumn(_AGE, F.lit(len(held) + 1))
        if held:
            stored = self._aged(self._of_parts(_ROWS, held, self.schema), held)
            if dict(stored.dtypes) != dict(rows.dtypes):
                return False
            rows = rows.unionByName(stored)
        dealt = self._dealt(rows, sum(p.rows for p in [*held, *arriving]))
        others = [c for c in changes.columns if c != self.key and c not in newest_first]
        order = [F.desc_nulls_last(c) for c in (*newest_first, *others)]
        window = Window.partitionBy(b, _SHARE, self.key).orderBy(F.desc(_AGE), *order)
        ranked = self._newest(dealt).withColumn(_RANK, F.row_number().over(window))
        kept = ranked.where((F.col(_RANK) == 1) | (F.col(_AGE) <= len(held))).drop(_RANK)
        self._write_dealt(kept.select(*changes.columns, b), version)
        written = self._counted(version)
        indexed = sum(written.values()) >= self.index_rows
        if indexed:
            self._write_index(version)
        now = time.time()
        dropped = [replace(p, dropped_at=now) if p in set(held) else p for p in parts]
        self._commit(number + 1, [*dropped, *[Part(k, version, n, 0, indexed) for k, n in written.items()]])
        return True

    def upsert_stored(
        self,
        changes: DataFrame,
        note: str | None = None,
        before_commit: Callable[[list, int], None] | None = None,
        carry: Sequence[str] = (),
    ) -> Upserted:
        """Upsert rows that are unique by key and cheap to read more than once.

        Rows without key are refused, since a second run would not find them again. Days are those
        of the column ``note`` over the rows being replaced, as they were before; distinct ones
        come to the driver. ``before_commit`` is given them, and the commit's number, before
        anything changes for readers. Columns to ``carry`` are kept of replaced rows, for
        ``replaced``.
        """
        b = self.bucket_column
        incoming = self._bucketed(changes)
        missing = F.count_if(F.col(self.key).isNull())
        # At most one row per bucket reaches the driver.
        sizes = incoming.groupBy(b).agg(F.count(F.lit(1)), missing).collect()
        if any(r[2] for r in sizes):
            raise ValueError(f"rows without {self.key} cannot be upserted")
        number, parts = self._parts()
        if not sizes:
            return Upserted([], None, number, number)
        live = [p for p in parts if p.dropped_at is None]
        version = _new_version()
        replaced, noted = self._write_gone(incoming, live, version, note, carry) if live else ({}, [])
        if before_commit is not None:
            before_commit(noted, number + 1)
        arriving = [Part(r[0], version, r[1], 0, False) for r in sizes]
        folded = self._with_stored(incoming, arriving, live)
        if folded is not None:
            # What is folded in stands in the place of the stored rows: nothing is marked.
            self._write_dealt(self._newest(folded), version)
            written, replaced = self._counted(version), {}
            dropped = {p for p in live if p.bucket in written}
        else:
            self._write(incoming, _ROWS, version)
            written, dropped = {p.bucket: p.rows for p in arriving}, set()
        indexed = sum(written.values()) >= self.index_rows
        if indexed:
            self._write_index(version)
        new = [Part(b, version, n, replaced.get(b, 0), indexed) for b, n in written.items()]
        now = time.time()
        kept = [replace(p, dropped_at=now) if p in dropped else p for p in parts]
        self._commit(number + 1, [*kept, *new])
        after = number + 1 + (1 if self._fold_due(number + 1, [*kept, *new]) else 0)
        return Upserted(noted, version, number, after)

    def _with_stored(
        self, incoming: DataFrame, arriving: Sequence[Part], live: Sequence[Part]
    ) -> DataFrame | None:
        """A large load together with the stored rows of its buckets, dealt for a fold, if it makes
        all of them due; else None."""
        asked = {p.bucket for p in arriving}
        held = [p for p in live if p.bucket in asked]
        if not held or sum(p.rows for p in arriving) < _SHARE_ROWS:
            return None
        own = _by_bucket(held)
        if not all(self._large(own[new.bucket], new.rows) for new in arriving):
            return None
        stored = self._aged(self._of_parts(_ROWS, held, self.schema), held)
        rows = incoming.withColumn(_AGE, F.lit(len(held) + 1))
        if dict(stored.dtypes) != dict(rows.dtypes):
            return None
        return self._dealt(rows.unionByName(stored), sum(p.rows for p in [*held, *arriving]))

    def replaced(self, version: str) -> DataFrame | None:
        """Key and carried columns of the rows that a version replaced; None if there were none."""
        folder = self._folder(_GONE, version)
        return self._open(_GONE, [folder], None) if _has_buckets(self.spark, folder) else None

    def _write_gone(
        self, incoming: DataFrame, live: Sequence[Part], version: str, note: str | None, carry: Sequence[str]
    ) -> tuple[dict[int, int], list]:
        """(replaced rows by bucket, their days); their keys and versions are written."""
        columns = list(dict.fromkeys([self.key, *([note] if note else []), *carry]))
        stored = self._holding(incoming, live, columns)
        day = F.lit(None).cast("date") if note is None else F.to_date(note)
        kept = [c for c in carry if c != self.key]
        rows = stored.select(
            self.key, F.col(VERSION_COLUMN).alias(_SUPERSEDED), self.bucket_column, day.alias("day"), *kept
        )
        self._write(rows, _GONE, version)
        if not _has_buckets(self.spark, self._folder(_GONE, version)):
            return {}, []
        written = self._open(_GONE, [self._folder(_GONE, version)], None)
        counted = written.groupBy(self.bucket_column).agg(F.count(F.lit(1)), F.collect_set("day")).collect()
        return {r[0]: r[1] for r in counted}, sorted({d for r in counted for d in r[2]})

    # --- folding ----------------------------------------------------------------------

    def _due(self, live: Sequence[Part]) -> dict[int, list[Part]]:
        """Bucket -> the parts to be folded into one."""
        by_bucket: dict[int, list[Part]] = defaultdict(list)
        for part in live:
            by_bucket[part.bucket].append(part)
        due = {}
        for bucket, held in by_bucket.items():
            base = max(held, key=lambda p: (p.rows, p.version))
            deltas = [p for p in held if p is not base]
            moved = sum(p.rows for p in deltas) + sum(p.gone for p in held)
            if deltas and moved >= self.fold_rows and moved > self.fold_share * base.rows:
                due[bucket] = held
            elif len(deltas) > self.max_deltas:
                due[bucket] = deltas
        return due

    def _large(self, held: Sequence[Part], arriving: int) -> bool:
        """Whether so many rows, beside the deltas, pass the share of the bucket's base."""
        if not held:
            return True
        base = max(p.rows for p in held)
        moved = sum(p.rows + p.gone for p in held) - base + arriving
        return moved >= self.fold_rows and moved > self.fold_share * base

    def fold(self) -> int:
        """Fold the buckets that are due, and no others; returns their number."""
        return self._fold_due(*self._parts())

    def _fold_due(self, number: int, parts: Sequence[Part]) -> int:
        due = self._due([p for p in parts if p.dropped_at is None])
        if due:
            self._fold(number, parts, due)
        return len(due)

    def compact(self) -> None:
        """Fold every bucket into a new base."""
        number, parts = self._parts()
        live: dict[int, list[Part]] = defaultdict(list)
        for part in parts:
            if part.dropped_at is None:
                live[part.bucket].append(part)
        if live:
            self._fold(number, parts, live)

    def _fold(self, number: int, parts: Sequence[Part], due: Mapping[int, Sequence[Part]]) -> None:
        merged = [p for held in due.values() for p in held]
        version = _new_version()
        live_here = [p for p in parts if p.dropped_at is None and p.bucket in due]
        stored = self._of_parts(_ROWS, merged, self.schema)
        stays = {p.bucket for p in set(live_here) - set(merged)}
        if stays:
            self._write(self._current(stored, live_here).drop(VERSION_COLUMN), _ROWS, version)
        else:
            # Nothing but the folded parts replaces their rows, so a key's last version is the valid one.
            dealt = self._dealt(self._aged(stored, merged), sum(p.rows for p in merged))
            self._write_dealt(self._newest(dealt), version)
        # What a folded delta replaces in a part that stays must remain known.
        kept_gone: dict[int, int] = {}
        gone = self._gone_of(merged) if stays else None
        if gone is not None:
            pairs = [(p.bucket, p.version) for p in merged]
            folded = self.spark.createDataFrame(pairs, f"{self.bucket_column} int, {_SUPERSEDED} string")
            left = gone.join(folded, [self.bucket_column, _SUPERSEDED], "left_anti").drop(VERSION_COLUMN)
            self._write(left, _GONE, version)
            if _has_buckets(self.spark, self._folder(_GONE, version)):
                kept_gone = _counts(self._open(_GONE, [self._folder(_GONE, version)], None), self.bucket_column)
        rows = self._counted(version)
        indexed = sum(rows.values()) >= self.index_rows
        if indexed:
            self._write_index(version)
        now = time.time()
        dropped = [replace(p, dropped_at=now) if p in set(merged) else p for p in parts]
        new = [Part(b, version, n, kept_gone.get(b, 0), indexed) for b, n in rows.items()]
        self._commit(number + 1, [*dropped, *new])


def _by_bucket(parts: Iterable[Part]) -> dict[int, list[Part]]:
    grouped: dict[int, list[Part]] = defaultdict(list)
    for part in parts:
        grouped[part.bucket].append(part)
    return grouped


def _counts(df: DataFrame, column: str) -> dict[int, int]:
    return {r[0]: r[1] for r in df.groupBy(column).agg(F.count(F.lit(1))).collect()}


def _has_buckets(spark: SparkSession, folder: str) -> bool:
    return exists(spark, folder) and any(n.startswith(_BUCKET_PREFIX) for n in children(spark, folder))


def _new_version() -> str:
    return f"v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
