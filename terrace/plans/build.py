"""Table builds: masters, dimensions and the incremental facts."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import ExitStack, contextmanager
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.layout import Layout
from terrace.operators.incremental import changes_since
from terrace.operators.joins import flag_known, orphans, referential_filter
from terrace.operators.keyed_table import KeyedTable
from terrace.plans import changes as change_log
from terrace.plans import fact_tests, models
from terrace.plans.masters import build_master as build_master
from terrace.plans.models import GOLD_TESTS
from terrace.schemas import DRIVERS, INGESTION_COLUMN, ORDERS, TELEMETRY, VEHICLES
from terrace.session import drops_shuffles
from terrace.sources.paths import children, delete, exists
from terrace.sources.versioned import is_published, publish, read_current, read_version
from terrace.staging import staged
from terrace.streaming.ingest import read_raw

_KNOWN = "_vehicle_known"


@dataclass(frozen=True)
class Progress:
    """How far raw has been folded into a fact and, for telemetry, what goes with that point:
    the folder of pending rows and the version of the known vehicles."""

    processed_to: datetime
    pending: str | None = None
    known: str | None = None


def read_progress(spark: SparkSession, path: str) -> Progress | None:
    if not is_published(spark, path):
        return None
    row = read_current(spark, path).first()
    return Progress(datetime.fromisoformat(row["processed_to"]), row["pending"], row["known"])


def write_progress(spark: SparkSession, path: str, progress: Progress) -> None:
    row = spark.range(0, 1, 1, 1).select(
        F.lit(progress.processed_to.isoformat(sep=" ")).alias("processed_to"),
        F.lit(progress.pending).cast("string").alias("pending"),
        F.lit(progress.known).cast("string").alias("known"),
    )
    publish(row, path)


def _days(df: DataFrame) -> list[date]:
    """Distinct ingestion days: a handful of dates, never rows."""
    days = df.select(F.to_date(INGESTION_COLUMN).alias("day")).distinct()
    return [row["day"] for row in days.collect()]


def _newest(df: DataFrame) -> datetime | None:
    text = df.agg(F.max(INGESTION_COLUMN).cast("string")).first()[0]
    return None if text is None else datetime.fromisoformat(text)


# --- masters and dimensions -------------------------------------------------------


@drops_shuffles
def build_dimensions(spark: SparkSession, layout: Layout) -> None:
    vehicles = read_current(spark, layout.raw(VEHICLES.name))
    drivers = read_current(spark, layout.raw(DRIVERS.name))
    publish(models.dim_vehicles(models.stg_vehicles(vehicles)), layout.gold("dim_vehicles"))
    publish(models.dim_drivers(models.stg_drivers(drivers)), layout.gold("dim_drivers"))


# --- facts ------------------------------------------------------------------------


def fact_table(spark: SparkSession, layout: Layout, name: str) -> KeyedTable:
    entity = {"fact_telemetry": TELEMETRY, "fact_orders": ORDERS}[name]
    raw = spark.createDataFrame([], entity.raw_schema)
    if entity is TELEMETRY:
        fact = models.fact_telemetry(models.telemetry_columns(raw))
    else:
        fact = models.fact_orders(models.stg_orders(raw))
    return KeyedTable(
        spark,
        layout.gold(name),
        entity.key,
        layout.fact_buckets,
        cluster_by=[INGESTION_COLUMN],
        schema=fact.schema,
    )


@drops_shuffles
def build_fact_telemetry(spark: SparkSession, layout: Layout, full: bool = False) -> list[date]:
    """Fold raw telemetry into the fact.

    The full form merges every raw row again. The default gives the same fact from the rows
    that arrived since the last run. Latest versions naming an unknown vehicle are set aside
    as *pending* and looked at again only when vehicles appear that were not known before.
    Progress is published last and names what belongs to it, so an interrupted run is redone.

    Returns the ingestion days whose stored rows changed: days that lost a row to a newer
    version and days that gained a late one. Their cold increments are out of date.
    """
    fact = fact_table(spark, layout, "fact_telemetry")
    progress_path = layout.state("fact_telemetry_progress")
    pending_root = layout.state("fact_telemetry_pending")
    known_path = layout.state("fact_telemetry_vehicles")
    vehicles = read_current(spark, layout.raw(VEHICLES.name)).select("vehicle_id")

    progress = None if full or not fact.exists() else read_progress(spark, progress_path)
    since = progress.processed_to if progress else None
    fresh = read_raw(spark, layout.raw(TELEMETRY.name), TELEMETRY, since)
    latest = models.latest_telemetry(fresh)
    with ExitStack() as tables:
        judged = tables.enter_context(
            staged(flag_known(latest, vehicles, "vehicle_id", _KNOWN), "telemetry")
        )
        newest = _newest(judged)
        if progress is None and newest is None:
            return []
        accepted = judged.where(F.col(_KNOWN)).drop(_KNOWN)
        late_days: list[date] = []
        if progress is not None:
            appeared = orphans(vehicles, read_version(spark, known_path, progress.known), "vehicle_id")
            pending = f"{pending_root}/{progress.pending}"
            if exists(spark, f"{pending}/_SUCCESS") and not appeared.isEmpty():
                set_aside = spark.read.schema(TELEMETRY.raw_schema).parquet(pending)
                released = tables.enter_context(
                    _released(set_aside, appeared, vehicles, judged, fact)
                )
                late_days = _days(released)
                accepted = accepted.unionByName(released)
        rows = models.fact_telemetry(models.telemetry_columns(accepted))

        def log(days: list[date], commit: int) -> None:
            change_log.append(spark, layout, "fact_telemetry", {*days, *late_days}, commit)

        parents = list(GOLD_TESTS["fact_telemetry"].relationships or {})
        done = fact.upsert_stored(rows, note=INGESTION_COLUMN, before_commit=log, carry=parents)
        fact_tests.update(
            spark, layout, "fact_telemetry", fact, GOLD_TESTS["fact_telemetry"], rows, None if full else done
        )
        # A full merge starts a pending folder of its own; the old one goes with its progress.
        pending_name = progress.pending if progress else uuid.uuid4().hex
        unknown = judged.where(~F.col(_KNOWN)).drop(_KNOWN)
        unknown.write.mode("append").parquet(f"{pending_root}/{pending_name}")
    known = publish(vehicles, known_path, protect=progress.known if progress else None)
    reached = max(t for t in (newest, since) if t is not None)
    write_progress(spark, progress_path, Progress(reached, pending_name, known))
    for name in children(spark, pending_root):
        if name != pending_name:
            delete(spark, f"{pending_root}/{name}")
    return sorted({*done.days, *late_days})


@contextmanager
def _released(
    pending: DataFrame,
    appeared: DataFrame,
    vehicles: DataFrame,
    fresh: DataFrame,
    fact: KeyedTable,
) -> Iterator[DataFrame]:
    """Pending rows that count now that their vehicle has appeared.

    A row counts if it is its event's newest version: of the pending ones, not overtaken by
    the fresh rows, and newer than what the fact holds. The fact is asked for the few keys in
    question through its index.
    """
    key = TELEMETRY.key
    events = referential_filter(pending, appeared, "vehicle_id").select(key).distinct()
    newest = models.latest_telemetry(referential_filter(pending, events, key))
    waiting = referential_filter(newest, vehicles, "vehicle_id").join(
        fresh.select(key), key, "left_anti"
    )
    with staged(waiting.select(*TELEMETRY.raw_schema.names), "released") as candidates:
        held = fact.lookup(candidates.select(key))
        merged = held.select(key, F.col(INGESTION_COLUMN).alias("merged_at"))
        overtaken = (
            merged.join(candidates.select(key, INGESTION_COLUMN), key)
            .where(F.col("merged_at") >= F.col(INGESTION_COLUMN))
            .select(key)
        )
        with staged(candidates.join(overtaken, key, "left_anti"), "late") as late:
            yield late.select(*TELEMETRY.raw_schema.names)


@drops_shuffles
def build_fact_orders(spark: SparkSession, layout: Layout, full: bool = False) -> list[date]:
    """Fold raw orders newer than the fact's watermark into the fact.

    Filtering before the dedup gives the rows filtering after it would: the version column
    is the watermark column, so a key's newest row passes exactly when any of its rows does.
    Returns the ingestion days that lost a row to a newer version.
    """
    fact = fact_table(spark, layout, "fact_orders")
    progress_path = layout.state("fact_orders_progress")
    progress = None if full or not fact.exists() else read_progress(spark, progress_path)
    if progress is not None:
        changes = read_raw(spark, layout.raw(ORDERS.name), ORDERS, progress.processed_to)
    else:
        raw = read_raw(spark, layout.raw(ORDERS.name), ORDERS)
        target = fact.read() if fact.exists() and not full else None
        changes = changes_since(raw, target, INGESTION_COLUMN)
    with staged(models.fact_orders(models.stg_orders(changes)), "orders") as staged_orders:
        newest = _newest(staged_orders)
        if newest is None:
            return []

        def log(days: list[date], commit: int) -> None:
            change_log.append(spark, layout, "fact_orders", days, commit)

        done = fact.upsert_stored(staged_orders, note=INGESTION_COLUMN, before_commit=log)
        fact_tests.update(
            spark, layout, "fact_orders", fact, GOLD_TESTS["fact_orders"], staged_orders, None if full else done
        )
    write_progress(spark, progress_path, Progress(newest))
    return done.days


def gold_readers(spark: SparkSession, layout: Layout) -> dict[str, Callable[[], DataFrame]]:
    """The gold tables by name, each opened on call."""
    return {
        "dim_vehicles": lambda: read_current(spark, layout.gold("dim_vehicles")),
        "dim_drivers": lambda: read_current(spark, layout.gold("dim_drivers")),
        "fact_telemetry": lambda: fact_table(spark, layout, "fact_telemetry").read(),
        "fact_orders": lambda: fact_table(spark, layout, "fact_orders").read(),
    }


def gold_tables(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    return {name: open_table() for name, open_table in gold_readers(spark, layout).items()}
