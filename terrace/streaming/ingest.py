"""Bronze files to the raw zone, each file once, as a Structured Streaming stream of file names.

The stream tells which files are new; a micro-batch reads them with the batch reader and publishes
their rows as one batch of the raw zone, named after the stream and its number.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from terrace.plans.silver import typed_and_stamped
from terrace.schemas import CORRUPT_COLUMN, INGESTION_COLUMN, Entity
from terrace.sources.json_batches import read_json_batches
from terrace.sources.paths import children, exists, make_folder, move
from terrace.staging import staged
from terrace.streaming.raw_zone import ACCEPTED, DAY_COLUMN, QUALITY_COLUMN, QUARANTINED, RawZone

# The file source ignores files this much older than the newest one. Its own default of a
# week would silently skip a batch that arrives late with an old file time, and one wrong clock
# all that follow, so by default no file is too old.
MAX_FILE_AGE = "36500d"

_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
_STREAM_PREFIX = "stream-"


@dataclass(frozen=True)
class ResendSuppression:
    """Drop resends of a key: rows whose event time lies within ``delay`` after or before that of
    a row of the same key which arrived before. How late a row arrives does not matter: the
    first one of its key and time always reaches raw. A correction sent inside the delay is
    lost, so this is off unless asked for. Rows without event time and records that do not
    parse are no resends. ``delay`` is an interval such as ``2 hours``."""

    time_column: str
    delay: str


def new_files(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    max_file_age: str = MAX_FILE_AGE,
) -> DataFrame:
    """A stream of the names of files below ``path``; their contents are not read."""
    reader = spark.readStream.format("binaryFile").schema(_FILE_SCHEMA)
    reader = reader.option("maxFileAge", max_file_age).option("recursiveFileLookup", True)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select("path")


def listed_files(spark: SparkSession, path: str, lists_per_trigger: int | None = None) -> DataFrame:
    """A stream of the file names in lists that are published below ``path``."""
    reader = spark.readStream.schema("path string").option("maxFileAge", MAX_FILE_AGE)
    if lists_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", lists_per_trigger)
    return reader.parquet(path)


def clean_batch(df: DataFrame, entity: Entity, run_ts: datetime | None = None) -> DataFrame:
    """The stateless part of silver cleaning. Records that do not parse stay, marked, in a
    partition of their own; duplicates stay for the latest-version step to resolve."""
    corrupt = F.col(CORRUPT_COLUMN).isNotNull()
    keyed = F.lit(True)
    for column in entity.required:
        keyed = keyed & F.col(column).isNotNull()
    rows = typed_and_stamped(df, entity, run_ts).where(corrupt | keyed)
    return rows.withColumns(
        {
            QUALITY_COLUMN: F.when(corrupt, QUARANTINED).otherwise(ACCEPTED),
            DAY_COLUMN: F.to_date(INGESTION_COLUMN),
        }
    )


def without_resends(rows: DataFrame, stored: DataFrame, key: str, suppression: ResendSuppression) -> DataFrame:
    """Rows that are no resend of a stored row or of an earlier row among themselves.

    Time is cut into stretches as long as the delay. Of a key and stretch only the first row can be
    no resend, and only if the last row of the stretch before lies more than the delay back; so
    rows shrink to one per key and stretch before they meet anything, however hot a key is.
    """
    time = F.col(suppression.time_column)
    names = rows.columns
    delay = F.expr(f"cast(interval {suppression.delay} as interval day to second)")
    length = F.expr(f"unix_micros(timestamp_micros(0) + interval {suppression.delay})")
    timed = (F.col(QUALITY_COLUMN) == ACCEPTED) & time.isNotNull() & F.col(key).isNotNull()
    stretch = F.expr(f"unix_micros(cast({suppression.time_column} as timestamp))")
    dealt = rows.where(timed).withColumn("_stretch", F.floor(stretch / length))
    others = [c for c in names if c != suppression.time_column]
    firsts = dealt.groupBy(key, "_stretch").agg(
        F.min(F.struct(suppression.time_column, *others)).alias("_row"),
        F.max(suppression.time_column).alias("_last"),
    )
    before = firsts.select(key, (F.col("_stretch") + 1).alias("_stretch"), F.col("_last").alias("_before"))
    own = firsts.join(before, [key, "_stretch"], "left")
    own = own.where(F.col("_before").isNull() | (F.col(f"_row.{suppression.time_column}") - F.col("_before") > delay))
    own = own.select(*[F.col(f"_row.{c}").alias(c) for c in names])
    seen = stored.select(F.col(key).alias("_key"), time.alias("_time")).where("_time is not null")
    near = (F.col("_time") >= time - delay) & (F.col("_time") <= time + delay)
    fresh = own.join(seen, (F.col(key) == F.col("_key")) & near, "left_anti")
    return fresh.unionByName(rows.where(~F.coalesce(timed, F.lit(False))))


def _stored_nearby(zone: RawZone, rows: DataFrame, suppression: ResendSuppression) -> DataFrame:
    """Raw rows in the range of the arriving rows' event times: the range reaches the scan."""
    time = suppression.time_column
    least, greatest = rows.agg(F.min(time).cast("string"), F.max(time).cast("string")).first()
    stored = zone.read()
    if least is None:
        return stored.limit(0)
    margin = F.expr(f"interval {suppression.delay}")
    low, high = F.lit(least).cast("timestamp") - margin, F.lit(greatest).cast("timestamp") + margin
    return stored.where(F.col(time).between(low, high))


def _stream_name(spark: SparkSession, checkpoint: str) -> str:
    """A name that lives and dies with the checkpoint, which numbers the batches."""
    own = f"{checkpoint}/identity"
    if not children(spark, own):
        make_folder(spark, f"{own}/{_STREAM_PREFIX}{uuid.uuid4().hex}")
    return children(spark, own)[0]


def _take(
    names: DataFrame,
    number: int,
    zone: RawZone,
    stream: str,
    run_ts: datetime | None,
    suppression: ResendSuppression | None,
    source: str,
    archive: str | None,
) -> None:
    """One micro-batch: read its files, publish their rows, put the files away."""
    spark, batch = zone.spark, f"{stream}-{number:012d}"
    # Names of files, as the listing had them on the driver.
    files = [row["path"] for row in names.select("path").distinct().collect()]
    done = any(b.name == batch for b in zone.live())
    if files and not done:
        rows = clean_batch(read_json_batches(spark, files, zone.entity.bronze_schema), zone.entity, run_ts)
        if suppression is None:
            zone.append(rows, batch, stream)
        else:
            with staged(rows, "arriving") as arriving:
                stored = _stored_nearby(zone, arriving, suppression)
                zone.append(without_resends(arriving, stored, zone.entity.key, suppression), batch, stream)
        zone.gather(run_ts.date() if run_ts else datetime.now(timezone.utc).date())
    if archive is not None:
        # A replayed batch finds those in place that it had moved.
        for file in files:
            if exists(spark, file):
                move(spark, file, f"{archive}/{file.split(source.rstrip('/'), 1)[-1].lstrip('/')}")


def start_ingest(
    spark: SparkSession,
    source: str,
    raw_path: str,
    checkpoint: str,
    entity: Entity,
    run_ts: datetime | None = None,
    every: str | None = None,
    max_files_per_trigger: int | None = None,
    suppression: ResendSuppression | None = None,
    archive: str | None = None,
    max_file_age: str = MAX_FILE_AGE,
    names: Callable[[], DataFrame] | None = None,
) -> StreamingQuery:
    """Append new bronze files to the raw zone. Without ``every`` the query takes what is there and
    stops; with it (say ``"10 minutes"``) the query runs at that cadence. ``names`` gives the
    stream of files if it is another than that of the files below ``source``. ``archive`` moves
    files there once their batch is published, so that the folder to list stays small."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    if names is None:
        names = partial(new_files, spark, source, max_files_per_trigger, max_file_age)
    zone, stream = RawZone(spark, raw_path, entity), _stream_name(spark, checkpoint)

    def take(df: DataFrame, number: int) -> None:
        _take(df, number, zone, stream, run_ts, suppression, source, archive)

    writer = names().writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()


def ingest_available(spark: SparkSession, *args, **options) -> None:
    """Run :func:`start_ingest` to the end of the files present now."""
    query = start_ingest(spark, *args, **options)
    query.awaitTermination()


def read_raw(
    spark: SparkSession, raw_path: str, entity: Entity, newer_than: datetime | None = None
) -> DataFrame:
    """Accepted rows, as :meth:`RawZone.read`."""
    return RawZone(spark, raw_path, entity).read(newer_than)


def read_quarantine(spark: SparkSession, raw_path: str, entity: Entity) -> DataFrame:
    return RawZone(spark, raw_path, entity).quarantine()
