from __future__ import annotations

from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from terrace.layout import Layout
from terrace.schemas import TELEMETRY
from terrace.sources.json_batches import land_batch
from terrace.sources.paths import delete
from terrace.streaming.ingest import (
    ResendSuppression,
    ingest_available,
    read_quarantine,
    read_raw,
    start_ingest,
)
from terrace.streaming.raw_zone import RawZone
from tests.helpers import event, plan, rows, telemetry, write_array, write_text

FIRST, SECOND = datetime(2024, 1, 1, 12), datetime(2024, 1, 2, 12)


@pytest.fixture
def layout(tmp_path):
    return Layout(str(tmp_path / "lake"))


def land(spark, layout, at, *records):
    land_batch(telemetry(spark, *records), layout.bronze("telemetry"), at)


def where(layout):
    return layout.bronze("telemetry"), layout.raw("telemetry"), layout.state("ingest_telemetry")


def ingest(spark, layout, run_ts=None, **options):
    ingest_available(spark, *where(layout), TELEMETRY, run_ts=run_ts, **options)


def raw(spark, layout, *args):
    return read_raw(spark, layout.raw("telemetry"), TELEMETRY, *args)


def test_each_file_is_taken_once(spark, layout):
    land(spark, layout, FIRST, event("E-1", "V-1"), event("E-2", "V-1"))
    ingest(spark, layout, FIRST)
    ingest(spark, layout, FIRST)
    land(spark, layout, SECOND, event("E-1", "V-2"))
    ingest(spark, layout, SECOND)
    got = raw(spark, layout).select("event_id", "vehicle_id", F.to_date("ingestion_date"))
    assert rows(got) == [
        ("E-1", "V-1", date(2024, 1, 1)),
        ("E-1", "V-2", date(2024, 1, 2)),
        ("E-2", "V-1", date(2024, 1, 1)),
    ]


def test_same_rows_as_the_batch_path(spark, layout):
    from terrace.plans.silver import clean_telemetry

    records = [event("E-1", "V-1", temp="x"), event(None, "V-1"), event("E-2", None), event("E-3", "V-3")]
    land(spark, layout, FIRST, *records)
    ingest(spark, layout, FIRST)
    batch = clean_telemetry(telemetry(spark, *records), FIRST)
    assert raw(spark, layout).schema == batch.schema
    assert rows(raw(spark, layout)) == rows(batch)


def test_unparseable_records_are_quarantined(spark, layout):
    land(spark, layout, FIRST, event("E-1", "V-1"))
    write_text(f"{layout.bronze('telemetry')}/cut.json", '[{"event_id": "E-2", ')
    ingest(spark, layout, FIRST)
    assert [r["event_id"] for r in raw(spark, layout).collect()] == ["E-1"]
    quarantined = read_quarantine(spark, layout.raw("telemetry"), TELEMETRY)
    assert [r["_corrupt_record"] for r in quarantined.collect()] == ['[{"event_id": "E-2", ']


def test_flat_array_files_are_taken_too(spark, layout):
    write_array(f"{layout.bronze('telemetry')}/batch_20240101_100000.json", [event("E-1", "V-1")])
    ingest(spark, layout, FIRST)
    assert raw(spark, layout).count() == 1


def test_newer_rows_prune_day_partitions(spark, layout):
    land(spark, layout, FIRST, event("E-1", "V-1"))
    ingest(spark, layout, FIRST)
    land(spark, layout, SECOND, event("E-2", "V-1"))
    ingest(spark, layout, SECOND)
    newer = raw(spark, layout, FIRST)
    assert [r["event_id"] for r in newer.collect()] == ["E-2"]
    assert raw(spark, layout, SECOND).count() == 0
    filters = plan(newer).split("PartitionFilters: [")[1].split("]")[0]
    assert "ingestion_day" in filters and "quality" in filters


def test_files_per_trigger_bound_the_batches(spark, layout):
    for hour in range(3):
        land(spark, layout, datetime(2024, 1, 1, hour), event(f"E-{hour}", "V-1"))
    query = start_ingest(spark, *where(layout), TELEMETRY, run_ts=FIRST, max_files_per_trigger=1)
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    assert raw(spark, layout).count() == 3


def test_cadence(spark, layout):
    land(spark, layout, FIRST, event("E-1", "V-1"))
    query = start_ingest(spark, *where(layout), TELEMETRY, run_ts=FIRST, every="1 second")
    try:
        query.processAllAvailable()
        land(spark, layout, SECOND, event("E-2", "V-1"))
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert raw(spark, layout).count() == 2


def test_resends_are_kept_unless_suppressed(spark, layout):
    suppression = ResendSuppression("timestamp", "2 hours")
    land(spark, layout, FIRST, event("E-1", "V-1"), event("E-2", "V-1"))
    ingest(spark, layout, FIRST, suppression=suppression)
    land(spark, layout, SECOND, event("E-1", "V-2", ts="2024-01-01T10:30:00Z"), event("E-3", "V-1"))
    ingest(spark, layout, SECOND, suppression=suppression)
    assert rows(raw(spark, layout).select("event_id", "vehicle_id")) == [
        ("E-1", "V-1"),
        ("E-2", "V-1"),
        ("E-3", "V-1"),
    ]


def test_late_first_arrivals_reach_raw_whatever_came_before(spark, layout):
    """The delay is far shorter than the range of times, and loads come out of order."""
    suppression = ResendSuppression("timestamp", "1 hour")
    loads = [
        [("E-9", "2024-01-09T10:00:00Z"), ("E-5", "2024-01-05T10:00:00Z")],
        [("E-1", "2024-01-01T10:00:00Z"), ("E-9", "2024-01-09T10:59:00Z"), ("E-9", "2024-01-09T08:30:00Z")],
        [("E-1", "2024-01-01T09:30:00Z"), ("E-5", "2024-01-05T11:00:01Z"), ("E-0", "2023-12-01T00:00:00Z")],
    ]
    for n, load in enumerate(loads):
        land(spark, layout, datetime(2024, 2, 1, n), *[event(k, "V-1", ts=t) for k, t in load])
        ingest(spark, layout, datetime(2024, 2, 1, n), suppression=suppression)
    got = raw(spark, layout).select("event_id", F.date_format("timestamp", "MM-dd HH:mm:ss").alias("at"))
    assert rows(got) == [
        ("E-0", "12-01 00:00:00"),
        ("E-1", "01-01 10:00:00"),
        ("E-5", "01-05 10:00:00"),
        ("E-5", "01-05 11:00:01"),
        ("E-9", "01-09 08:30:00"),
        ("E-9", "01-09 10:00:00"),
    ]


def test_resends_within_a_batch_and_rows_without_time(spark, layout):
    suppression = ResendSuppression("timestamp", "1 hour")
    times = ["10:00:00", "10:50:00", "11:40:00", "13:00:00", "13:00:00"]
    hot = [event("E-1", "V-1", ts=f"2024-01-01T{t}Z") for t in times]
    odd = [event("E-2", "V-1", ts="no time"), event("E-2", "V-1", ts=None)]
    land(spark, layout, FIRST, *hot, *odd)
    write_text(f"{layout.bronze('telemetry')}/cut.json", '{"event_id": "E-3"\n{"event_id": "E-3"')
    ingest(spark, layout, FIRST, suppression=suppression)
    # Each of the first three lies within an hour of the one before it.
    got = rows(raw(spark, layout).select("event_id", F.date_format("timestamp", "HH:mm").alias("at")))
    assert got == [("E-1", "10:00"), ("E-1", "13:00"), ("E-2", None), ("E-2", None)]
    assert read_quarantine(spark, layout.raw("telemetry"), TELEMETRY).count() == 2


def test_a_replayed_batch_adds_nothing(spark, layout):
    """The stream forgets its last commit, as when it dies between the batch and the mark."""
    for n in range(2):
        land(spark, layout, datetime(2024, 1, 1, n), event(f"E-{n}", "V-1"))
        ingest(spark, layout, datetime(2024, 1, 1, n))
    before = raw(spark, layout).collect()
    delete(spark, f"{layout.state('ingest_telemetry')}/commits/1")
    ingest(spark, layout, datetime(2024, 1, 1, 5))
    assert sorted(raw(spark, layout).collect()) == sorted(before) and len(before) == 2


def test_a_batch_that_died_before_it_was_published_is_not_read(spark, layout, monkeypatch):
    land(spark, layout, FIRST, event("E-1", "V-1"))
    with monkeypatch.context() as broken:
        broken.setattr(RawZone, "_publish", lambda *_: 1 / 0)
        with pytest.raises(Exception, match="ZeroDivision"):
            ingest(spark, layout, FIRST)
    assert raw(spark, layout).count() == 0
    ingest(spark, layout, FIRST)
    assert raw(spark, layout).count() == 1


def test_closed_batches_are_gathered(spark, layout):
    zone = RawZone(spark, layout.raw("telemetry"), TELEMETRY, gather_at=3)
    for n in range(5):
        land(spark, layout, datetime(2024, 1, 1 + n, 1), event(f"E-{n}", "V-1"), event(f"F-{n}", None))
        ingest(spark, layout, datetime(2024, 1, 1 + n, 1))
    opened, before = raw(spark, layout), rows(raw(spark, layout))
    assert len(zone.live()) == 5
    assert zone.gather(date(2024, 1, 3)) == 0
    # The newest batch stays, since it may be replayed.
    assert zone.gather(date(2024, 2, 1)) == 4
    assert len(zone.live()) == 2
    assert rows(raw(spark, layout)) == before == rows(opened)
    assert raw(spark, layout, datetime(2024, 1, 4)).count() == 2
    assert zone.gather(date(2024, 2, 1)) == 0


def test_reading_raw_lists_no_log(spark, layout):
    land(spark, layout, FIRST, event("E-1", "V-1"))
    ingest(spark, layout, FIRST)
    assert not list(Path(layout.raw("telemetry")).rglob("_spark_metadata"))


def test_taken_files_move_to_the_archive(spark, layout, tmp_path):
    archive = tmp_path / "archive"
    bronze = Path(layout.bronze("telemetry"))
    for hour in range(3):
        land(spark, layout, datetime(2024, 1, 1, hour), event(f"E-{hour}", "V-1"))
        ingest(spark, layout, datetime(2024, 1, 2, hour), archive=str(archive))
    # Files without a byte hold no record and are never taken.
    kept = {f.parent.name for f in bronze.rglob("*.json") if f.stat().st_size}
    moved = {f.parent.name for f in archive.rglob("*.json")}
    assert moved and not moved & kept and len(moved | kept) == 3
    assert raw(spark, layout).count() == 3
