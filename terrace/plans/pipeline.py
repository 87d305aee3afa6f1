"""The whole run, in dependency order."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date, datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from terrace.layout import Layout
from terrace.operators.quality import require_passed
from terrace.plans import build
from terrace.plans.gates import gate_and_admit, gold_tests, gold_tests_by_change
from terrace.schemas import FEEDS, INGESTION_COLUMN, MASTERS, TELEMETRY, Entity
from terrace.session import configure
from terrace.sources.json_batches import land_batch, land_daily_snapshot
from terrace.sources.versioned import is_published, read_current
from terrace.streaming.ingest import listed_files, read_quarantine, start_ingest
from terrace.streaming.raw_zone import DAY_COLUMN
from terrace.together import run_together


@dataclass
class RunReport:
    run_ts: datetime
    gate: list[dict] = field(default_factory=list)
    tests: list[dict] = field(default_factory=list)
    # Table -> records that did not parse: all of a master's extracts, this run's of a feed.
    quarantined: dict[str, int] = field(default_factory=dict)
    # Fact -> days before this run whose stored rows changed.
    changed_days: dict[str, list[date]] = field(default_factory=dict)


def land_masters(layout: Layout, masters: Mapping[str, DataFrame], day: date) -> None:
    for name, df in masters.items():
        land_daily_snapshot(df, layout.bronze(name), day)


def land_batches(layout: Layout, feeds: Mapping[str, DataFrame], batch_ts: datetime) -> None:
    for name, df in feeds.items():
        land_batch(df, layout.bronze(name), batch_ts)


def _check_run_time(spark: SparkSession, layout: Layout, run_ts: datetime) -> None:
    for fact in ("fact_telemetry", "fact_orders"):
        progress = build.read_progress(spark, layout.state(f"{fact}_progress"))
        if progress and run_ts <= progress.processed_to:
            raise ValueError(f"run_ts {run_ts} is not after the last run ({progress.processed_to})")


def ingest_feeds(spark: SparkSession, layout: Layout, run_ts: datetime | None = None) -> None:
    """Telemetry from the lists of files that its gate has admitted, the others as they land."""

    def start(entity: Entity) -> StreamingQuery:
        names = None
        if entity is TELEMETRY:
            lists, at_a_time = layout.admitted(entity.name), layout.max_files_per_trigger and 1
            names = partial(listed_files, spark, lists, at_a_time)
        return start_ingest(
            spark,
            layout.bronze(entity.name),
            layout.raw(entity.name),
            layout.state(f"ingest_{entity.name}"),
            entity,
            run_ts=run_ts,
            max_files_per_trigger=layout.max_files_per_trigger,
            archive=layout.archive(entity.name) if layout.archive_taken else None,
            names=names,
        )

    for stream in [start(entity) for entity in FEEDS]:
        stream.awaitTermination()


def _quarantined(spark: SparkSession, layout: Layout, run_ts: datetime) -> dict[str, int]:
    counts = {}
    for entity in MASTERS:
        path = layout.quarantine(entity.name)
        counts[entity.name] = read_current(spark, path).count() if is_published(spark, path) else 0
    instant = F.lit(run_ts.isoformat(sep=" ")).cast("timestamp")
    for entity in FEEDS:
        rows = read_quarantine(spark, layout.raw(entity.name), entity)
        own = (F.col(DAY_COLUMN) == F.lit(run_ts.date())) & (F.col(INGESTION_COLUMN) == instant)
        counts[entity.name] = rows.where(own).count()
    return counts


def run_pipeline(
    spark: SparkSession,
    layout: Layout,
    run_ts: datetime,
    full: bool = False,
    max_corrupt: int = 0,
) -> RunReport:
    """Gate, clean, build, test. A failed gate or test raises and stops what comes after.

    ``run_ts`` (UTC) stamps every row of the run and must move forward from run to run.
    ``full`` judges all landed files, parses all extracts, merges all raw rows and tests whole facts
    again, instead of what is new; the tables come out the same. More than ``max_corrupt`` telemetry records that do not parse
    fail the gate.
    """
    configure(spark)
    _check_run_time(spark, layout, run_ts)
    report = RunReport(run_ts)
    report.gate = gate_and_admit(spark, layout, full, max_corrupt)
    masters = [partial(build.build_master, spark, layout, e, run_ts, full) for e in MASTERS]
    run_together(spark, [*masters, partial(ingest_feeds, spark, layout, run_ts)])
    report.quarantined = _quarantined(spark, layout, run_ts)
    _, telemetry_days, order_days = run_together(
        spark,
        [
            partial(build.build_dimensions, spark, layout),
            partial(build.build_fact_telemetry, spark, layout, full),
            partial(build.build_fact_orders, spark, layout, full),
        ],
    )
    for fact, days in (("fact_telemetry", telemetry_days), ("fact_orders", order_days)):
        report.changed_days[fact] = [day for day in days if day < run_ts.date()]
    if full:
        tests = gold_tests(build.gold_tables(spark, layout))
    else:
        readers = build.gold_readers(spark, layout)
        dimensions = {name: readers[name]() for name in ("dim_vehicles", "dim_drivers")}
        tests = gold_tests_by_change(spark, layout, dimensions)
    report.tests = require_passed(tests)
    return report
