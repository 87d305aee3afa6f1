"""Daily export of gold to cold history."""

from __future__ import annotations

from collections.abc import Callable, Collection
from dataclasses import dataclass
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from terrace.functions.columns import with_stored_keys
from terrace.layout import Layout
from terrace.operators.snapshots import INCREMENT_PARTITION, export, refresh_increments
from terrace.plans import changes
from terrace.plans.build import fact_table, gold_readers
from terrace.session import drops_shuffles
from terrace.sources.paths import children
from terrace.together import run_together

FACTS = ("fact_orders", "fact_telemetry")


@dataclass(frozen=True)
class ExportResult:
    table: str
    path: str
    day: date
    rows: int
    status: str
    error: str | None = None


class BackupError(RuntimeError):
    def __init__(self, results: list[ExportResult]):
        failed = [r for r in results if r.status == "failed"]
        super().__init__("; ".join(f"{r.table}: {r.error}" for r in failed))
        self.results = results


@drops_shuffles
def export_tables(
    spark: SparkSession,
    tables: dict[str, tuple[Callable[[], DataFrame], str]],
    day: date,
    stored: bool = False,
) -> list[ExportResult]:
    """Export each table; one that fails does not stop the others, but the call then raises.

    ``tables`` maps a name to (open the table, target path). A table without rows for the
    day is reported as skipped. ``stored`` as for :func:`export_increment`.
    """

    def export_one(name: str, open_table: Callable[[], DataFrame], path: str) -> ExportResult:
        try:
            rows = export(open_table(), path, day, stored=stored)
            return ExportResult(name, path, day, rows, "exported" if rows else "skipped")
        except Exception as error:  # noqa: BLE001 - isolated here, raised below
            return ExportResult(name, path, day, 0, "failed", str(error))

    actions = [partial(export_one, name, *target) for name, target in tables.items()]
    results = run_together(spark, actions)
    if any(r.status == "failed" for r in results):
        raise BackupError(results)
    return results


def _sources(
    spark: SparkSession, layout: Layout
) -> dict[str, tuple[Callable[[], DataFrame], str]]:
    """Table -> (open it, cold path). Normalised keys are stored alongside, so that metrics
    filter at the scan."""
    gold = gold_readers(spark, layout)

    def keyed(name: str, *columns: str) -> Callable[[], DataFrame]:
        return lambda: with_stored_keys(gold[name](), *columns)

    return {
        "fact_orders": (gold["fact_orders"], layout.history("orders")),
        "fact_telemetry": (
            keyed("fact_telemetry", "vehicle_id", "delivery_status"),
            layout.history("telemetry"),
        ),
        "dim_vehicles": (
            keyed("dim_vehicles", "vehicle_id"),
            layout.snapshots("dim_vehicles"),
        ),
        "dim_drivers": (gold["dim_drivers"], layout.snapshots("dim_drivers")),
    }


@drops_shuffles
def run_backup(spark: SparkSession, layout: Layout, day: date) -> list[ExportResult]:
    """Facts as increments of ``day``, dimensions as snapshots dated ``day``. Repeating a day
    replaces it. Exported days that runs have changed since are brought in line, so that
    every event is in the history once, in its newest version. Runs may go on meanwhile: what
    they change stays in the log."""
    logged = [e for fact in FACTS for e in changes.entries(spark, layout, fact)]
    reached = {fact: fact_table(spark, layout, fact).commit_number() for fact in FACTS}
    results = export_tables(spark, _sources(spark, layout), day, stored=True)
    for fact in FACTS:
        own = [e for e in logged if e.fact == fact]
        refresh_history(spark, layout, fact, changes.days_of(spark, own), day)
    changes.consume(spark, logged, reached)
    return results


def read_changed_days(spark: SparkSession, layout: Layout) -> dict[str, list[date]]:
    """Fact -> days that runs changed since the last backup: dates, never rows."""
    found = {f: changes.days_of(spark, changes.entries(spark, layout, f)) for f in FACTS}
    return {fact: days for fact, days in found.items() if days}


@drops_shuffles
def refresh_history(
    spark: SparkSession, layout: Layout, fact: str, days: Collection[date], last_day: date
) -> None:
    """Bring exported days in line with the fact after corrections and late rows. Days that are
    yet to be exported, after ``last_day`` and not in the history, will be so in their newest state."""
    open_table, path = _sources(spark, layout)[fact]
    exported = set(children(spark, path))
    due = [d for d in days if d <= last_day or f"{INCREMENT_PARTITION}={d.isoformat()}" in exported]
    if due:
        refresh_increments(open_table(), path, due)
