"""The raw zone: rows of ingestion batches, each batch a folder of its own, listed in a manifest.

A batch is written to its folder and then published, so a batch that dies half way is not read and
one that is replayed writes the same folder again or, if it was published, nothing. Readers list
the folders the manifest names and no log. Batches whose days are over are gathered into larger
folders; what they held leaves ``keep_seconds`` after that, for readers that had opened it.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.schemas import CORRUPT_COLUMN, INGESTION_COLUMN, Entity
from terrace.session import TABLE_CODEC
from terrace.sources.paths import children, delete
from terrace.sources.versioned import is_published, publish, read_current

QUALITY_COLUMN = "quality"
DAY_COLUMN = "ingestion_day"
BATCH_COLUMN = "batch"
ACCEPTED = "ok"
QUARANTINED = "corrupt"

_MANIFEST_SCHEMA = (
    "batch string, stream string, first_day date, last_day date, rows long, dropped_at double"
)
_GATHERED = "gathered"


@dataclass(frozen=True)
class Batch:
    """A published folder; ``stream`` names what wrote it. ``dropped_at``: when its rows were
    gathered elsewhere, in seconds."""

    name: str
    stream: str
    first_day: date | None
    last_day: date | None
    rows: int
    dropped_at: float | None = None


class RawZone:
    """The raw rows of one feed. One writer at a time, any number of readers.

    ``gather_at`` is the number of closed batches that are gathered into one folder.
    """

    def __init__(
        self, spark: SparkSession, path: str, entity: Entity, gather_at: int = 16, keep_seconds: float = 3600
    ):
        self.spark = spark
        self.path = path
        self.entity = entity
        self.gather_at = gather_at
        self.keep_seconds = keep_seconds

    @property
    def _manifest(self) -> str:
        return f"{self.path}/manifest"

    def _folder(self, name: str) -> str:
        return f"{self.path}/batches/{BATCH_COLUMN}={name}"

    def _batches(self) -> list[Batch]:
        """One entry per folder; gathering keeps them few."""
        if not is_published(self.spark, self._manifest):
            return []
        return [Batch(*row) for row in read_current(self.spark, self._manifest).collect()]

    def live(self) -> list[Batch]:
        return [b for b in self._batches() if b.dropped_at is None]

    def _publish(self, batches: Iterable[Batch]) -> None:
        expired = time.time() - self.keep_seconds
        kept = [b for b in batches if b.dropped_at is None or b.dropped_at > expired]
        data = [(b.name, b.stream, b.first_day, b.last_day, b.rows, b.dropped_at) for b in kept]
        publish(self.spark.createDataFrame(data, _MANIFEST_SCHEMA).coalesce(1), self._manifest, keep_seconds=0)
        named = {f"{BATCH_COLUMN}={b.name}" for b in kept}
        for folder in children(self.spark, f"{self.path}/batches"):
            if folder not in named:
                delete(self.spark, f"{self.path}/batches/{folder}")

    # --- writing ----------------------------------------------------------------------

    def append(self, rows: DataFrame, name: str, stream: str) -> None:
        """Publish the rows as the batch ``name``; a batch that is published already is left
        as it is."""
        batches = self._batches()
        if any(b.name == name for b in batches):
            return
        self._write(rows, name)
        self._publish([*batches, self._measured(name, stream)])

    def _write(self, rows: DataFrame, name: str) -> None:
        writer = rows.write.partitionBy(QUALITY_COLUMN, DAY_COLUMN).mode("overwrite")
        writer = writer.option("partitionOverwriteMode", "static").option("compression", TABLE_CODEC)
        writer.parquet(self._folder(name))

    def _measured(self, name: str, stream: str) -> Batch:
        written = self._open([name])
        found = written.agg(F.min(DAY_COLUMN), F.max(DAY_COLUMN), F.count(F.lit(1))).first()
        return Batch(name, stream, *found)

    def gather(self, today: date) -> int:
        """Gather batches whose days are before ``today`` into one folder, with large files by
        day, once there are ``gather_at`` of them; returns how many were. The newest batch of a stream
        stays by itself, since it may be replayed."""
        batches = self._batches()
        live = [b for b in batches if b.dropped_at is None and b.stream != _GATHERED]
        newest = {b.stream: b for b in live}
        closed = [
            b for b in live
            if newest[b.stream] is not b and (b.last_day is None or b.last_day < today)
        ]
        if len(closed) < self.gather_at:
            return 0
        name = f"{_GATHERED}-{uuid.uuid4().hex}"
        rows = self._open([b.name for b in closed if b.rows]).drop(BATCH_COLUMN) if any(b.rows for b in closed) else None
        now = time.time()
        kept = [replace(b, dropped_at=now) if b in closed else b for b in batches]
        if rows is not None:
            self._write(rows.hint("rebalance", QUALITY_COLUMN, DAY_COLUMN), name)
            kept.append(self._measured(name, _GATHERED))
        self._publish(kept)
        return len(closed)

    # --- reading ----------------------------------------------------------------------

    def _open(self, names: Sequence[str]) -> DataFrame:
        fields = [
            *self.entity.raw_schema.fields,
            T.StructField(CORRUPT_COLUMN, T.StringType()),
            T.StructField(BATCH_COLUMN, T.StringType()),
            T.StructField(QUALITY_COLUMN, T.StringType()),
            T.StructField(DAY_COLUMN, T.DateType()),
        ]
        reader = self.spark.read.schema(T.StructType(fields)).option("basePath", f"{self.path}/batches")
        return reader.parquet(*[self._folder(n) for n in names])

    def _rows(self, quality: str, newer_than: datetime | None = None) -> DataFrame:
        held = [b for b in self.live() if b.rows]
        if newer_than is not None:
            held = [b for b in held if b.last_day >= newer_than.date()]
        if not held:
            schema = "quality string, ingestion_day date"
            fields = [*self.entity.raw_schema.fields, T.StructField(CORRUPT_COLUMN, T.StringType())]
            return self.spark.createDataFrame([], T.StructType([*fields, *T._parse_datatype_string(schema).fields]))
        rows = self._open([b.name for b in held]).where(F.col(QUALITY_COLUMN) == quality)
        if newer_than is not None:
            rows = rows.where(F.col(DAY_COLUMN) >= F.lit(newer_than.date()))
        return rows

    def read(self, newer_than: datetime | None = None) -> DataFrame:
        """Accepted rows. ``newer_than`` (exclusive) skips the batches and days before it."""
        rows = self._rows(ACCEPTED, newer_than)
        if newer_than is not None:
            instant = F.lit(newer_than.isoformat(sep=" ")).cast("timestamp")
            rows = rows.where(F.col(INGESTION_COLUMN) > instant)
        return rows.select(*self.entity.raw_schema.names)

    def quarantine(self) -> DataFrame:
        return self._rows(QUARANTINED).select(CORRUPT_COLUMN, INGESTION_COLUMN, DAY_COLUMN)
