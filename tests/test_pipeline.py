from __future__ import annotations

import json
import os
import random
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest

from terrace.layout import Layout
from terrace.operators.quality import QualityGateError
from terrace.operators.snapshots import read_history, read_snapshots
from terrace.plans import build, masters
from terrace.plans.backup import BackupError, export_tables, read_changed_days, run_backup
from terrace.plans.gates import admitted_files, gate_and_admit, gold_tests, gold_tests_by_change
from terrace.plans.metrics import as_records, fleet_metrics, temperature_alerts
from terrace.plans.pipeline import ingest_feeds, land_batches, land_masters, run_pipeline
from terrace.plans.views import register_views
from terrace.schemas import DRIVERS, TELEMETRY, VEHICLES
from terrace.sources.paths import delete
from terrace.sources.versioned import read_current
from terrace.streaming.ingest import read_raw
from terrace.together import run_together
from tests.helpers import (
    driver,
    drivers,
    event,
    order,
    orders,
    rows,
    telemetry,
    vehicle,
    vehicles,
)

DAY1 = datetime(2024, 1, 1, 12)
SEEDS = [int(n) for n in os.environ.get("TEST_SEEDS", "1").split(",")]
DAY2, DAY3 = DAY1 + timedelta(days=1), DAY1 + timedelta(days=2)


@pytest.fixture
def layout(tmp_path):
    return Layout(str(tmp_path / "lake"), fact_buckets=3)


def land(spark, layout, at, fleet=(), crew=(), events=(), dispatches=()):
    masters = {"vehicles": vehicles(spark, *fleet), "drivers": drivers(spark, *crew)}
    land_masters(layout, {k: v for k, v in masters.items() if not v.isEmpty()}, at.date())
    feeds = {"telemetry": telemetry(spark, *events), "orders": orders(spark, *dispatches)}
    land_batches(layout, {k: v for k, v in feeds.items() if not v.isEmpty()}, at)


def first_load(spark, layout):
    land(
        spark,
        layout,
        DAY1,
        fleet=[vehicle("V-1"), vehicle("V-2", "3000")],
        crew=[driver("D-1"), driver("D-2", status="AWAY")],
        events=[event("E-1", "V-1", temp="9"), event("E-2", "V-9", temp="13"), event("E-3", "V-2")],
        dispatches=[order("O-1"), order("O-2")],
    )


def gold(spark, layout):
    return {name: rows(df) for name, df in build.gold_tables(spark, layout).items()}


def ids(spark, layout, name="fact_telemetry"):
    return [r[0] for r in rows(build.fact_table(spark, layout, name).read())]


def test_run_builds_and_tests_gold(spark, layout):
    first_load(spark, layout)
    report = run_pipeline(spark, layout, DAY1)
    assert len(report.gate) == 5 and len(report.tests) == 12
    assert all(r["passed"] for r in report.gate + report.tests)
    tables = gold(spark, layout)
    assert tables["dim_vehicles"] == [("V-1", "Van", 1500, "ACTIVE"), ("V-2", "Van", 3000, "ACTIVE")]
    assert tables["dim_drivers"] == [("D-1", "A Name", "Class A", "AVAILABLE")]
    assert ids(spark, layout) == ["E-1", "E-3"]
    assert ids(spark, layout, "fact_orders") == ["O-1", "O-2"]


def test_rerun_without_new_files_changes_nothing(spark, layout):
    first_load(spark, layout)
    run_pipeline(spark, layout, DAY1)
    before = gold(spark, layout)
    run_pipeline(spark, layout, DAY2)
    assert gold(spark, layout) == before
    run_pipeline(spark, layout, DAY3, full=True)
    assert gold(spark, layout) == before


def test_corrections_replace_and_late_vehicles_release_events(spark, layout):
    first_load(spark, layout)
    run_pipeline(spark, layout, DAY1)
    land(
        spark,
        layout,
        DAY2,
        fleet=[vehicle("V-1", "8000"), vehicle("V-9")],
        crew=[driver("D-1")],
        events=[event("E-1", "V-2", temp="1")],
        dispatches=[order("O-2", product="Pallet")],
    )
    report = run_pipeline(spark, layout, DAY2)
    assert report.changed_days == {"fact_telemetry": [DAY1.date()], "fact_orders": [DAY1.date()]}
    fact = build.fact_table(spark, layout, "fact_telemetry").read()
    assert rows(fact.select("event_id", "vehicle_id", "temperature_alert_status")) == [
        ("E-1", "V-2", "CRITICAL_LOW"),
        ("E-2", "V-9", "CRITICAL_HIGH"),
        ("E-3", "V-2", "NORMAL"),
    ]
    order_fact = build.fact_table(spark, layout, "fact_orders").read()
    assert rows(order_fact.select("order_id", "product_name")) == [("O-1", "Crate"), ("O-2", "Pallet")]
    dims = gold(spark, layout)["dim_vehicles"]
    assert [(r[0], r[2]) for r in dims] == [("V-1", 8000), ("V-2", 3000), ("V-9", 1500)]


def test_event_whose_newest_version_is_unknown_keeps_its_merged_row(spark, layout):
    first_load(spark, layout)
    run_pipeline(spark, layout, DAY1)
    land(spark, layout, DAY2, events=[event("E-1", "V-77", temp="1")])
    run_pipeline(spark, layout, DAY2)
    fact = build.fact_table(spark, layout, "fact_telemetry").read()
    assert ("E-1", "V-1") in rows(fact.select("event_id", "vehicle_id"))


def test_failed_gate_stops_the_run_until_the_file_is_gone(spark, layout):
    first_load(spark, layout)
    land(spark, layout, DAY2, events=[event("E-4", "V-1", temp="500")])
    for _ in range(2):
        with pytest.raises(QualityGateError, match="cargo_temp_c"):
            run_pipeline(spark, layout, DAY1)
    assert not Path(layout.raw("telemetry")).exists()
    assert not Path(layout.gold("fact_telemetry")).exists()
    delete(spark, f"{layout.bronze('telemetry')}/batch_20240102_120000")
    run_pipeline(spark, layout, DAY1)
    assert ids(spark, layout) == ["E-1", "E-3"]


def test_gate_judges_what_is_ingested_whatever_its_file_time(spark, layout):
    first_load(spark, layout)
    run_pipeline(spark, layout, DAY1)
    land(spark, layout, DAY2, events=[event("E-9", "V-1", temp="999")])
    for file in Path(layout.bronze("telemetry")).rglob("part-*"):
        os.utime(file, (1, 1))
    with pytest.raises(QualityGateError, match="cargo_temp_c"):
        run_pipeline(spark, layout, DAY2)
    assert "E-9" not in ids(spark, layout)
    land_file = Path(layout.bronze("telemetry")) / "late.json"
    delete(spark, f"{layout.bronze('telemetry')}/batch_20240102_120000")
    land_file.write_text(json.dumps([event("E-10", "V-1")], indent=2))
    os.utime(land_file, (10**9, 10**9))
    run_pipeline(spark, layout, DAY2)
    assert "E-10" in ids(spark, layout) and land_file.exists()
    admitted = [r["path"] for r in admitted_files(spark, layout).collect()]
    assert len(admitted) == len(set(admitted)) and f"file:{land_file}" in admitted


def test_admission_is_one_write_and_moves_nothing(spark, layout):
    folder = Path(layout.bronze("telemetry"))
    folder.mkdir(parents=True)
    for n in range(300):
        (folder / f"f{n}.json").write_text(json.dumps([event(f"E-{n}", "V-1")]))
    before = sorted(folder.iterdir())
    gate_and_admit(spark, layout)
    assert sorted(folder.iterdir()) == before and admitted_files(spark, layout).count() == 300
    assert len(list(Path(layout.admitted("telemetry")).glob("*.parquet"))) == 1
    gate_and_admit(spark, layout)
    assert admitted_files(spark, layout).count() == 300
    (folder / "late.json").write_text(json.dumps([event("E-300", "V-1")]))
    ingest_feeds_of_telemetry(spark, layout)
    assert read_raw(spark, layout.raw("telemetry"), TELEMETRY).count() == 300
    gate_and_admit(spark, layout)
    ingest_feeds_of_telemetry(spark, layout)
    assert read_raw(spark, layout.raw("telemetry"), TELEMETRY).count() == 301


def ingest_feeds_of_telemetry(spark, layout):
    Path(layout.bronze("orders")).mkdir(parents=True, exist_ok=True)
    ingest_feeds(spark, layout, DAY1)


def test_unreadable_master_keeps_the_old_one_and_shows(spark, layout):
    first_load(spark, layout)
    run_pipeline(spark, layout, DAY1)
    before = gold(spark, layout)["dim_vehicles"]
    delete(spark, layout.bronze("vehicles"))
    (Path(layout.bronze("vehicles"))).mkdir(parents=True)
    (Path(layout.bronze("vehicles")) / "vehicles_20240102.json").write_text('[{"vehicle_id": ')
    report = run_pipeline(spark, layout, DAY2)
    assert gold(spark, layout)["dim_vehicles"] == before
    assert report.quarantined["vehicles"] == 1 and report.quarantined["telemetry"] == 0


@pytest.mark.parametrize("seed", SEEDS)
def test_masters_fold_unseen_extracts_only(spark, tmp_path, monkeypatch, seed):
    """Against parsing all extracts: days come in and out of order, are landed again, and go."""
    rng, parsed = random.Random(seed), []
    layout, whole = Layout(str(tmp_path / "folded")), Layout(str(tmp_path / "whole"))
    read = masters.read_json_batches

    def watched(spark, files, *args, **options):
        parsed.append(files)
        return read(spark, files, *args, **options)

    monkeypatch.setattr(masters, "read_json_batches", watched)
    for n in range(7):
        day = date(2024, 1, n + 1 if n not in (3, 5) else rng.randrange(1, 6))
        fleet = [vehicle(f"V-{rng.randrange(6)}", str(rng.choice([900, 1500, 8000]))) for _ in range(4)]
        extract = vehicles(spark, *fleet)
        for lake in (layout, whole):
            land_masters(lake, {"vehicles": extract}, day)
            if n == 4:
                delete(spark, f"{lake.bronze('vehicles')}/vehicles_20240102")
            assert build.build_master(spark, lake, VEHICLES, DAY1, full=lake is whole)
        folded, again = (rows(read_current(spark, lake.raw("vehicles"))) for lake in (layout, whole))
        assert folded == again
    parsed.clear()
    land_masters(layout, {"vehicles": vehicles(spark, vehicle("V-7"))}, date(2024, 1, 20))
    build.build_master(spark, layout, VEHICLES, DAY1)
    days = {f.split("vehicles_")[1][:8] for f in parsed[0]}
    assert "20240120" in days and len(days) == 2


def test_failed_table_test_raises(spark, layout):
    land(
        spark,
        layout,
        DAY1,
        fleet=[vehicle("V-1", capacity="unknown")],
        crew=[driver("D-1")],
        events=[event("E-1", "V-1")],
        dispatches=[order("O-1")],
    )
    with pytest.raises(QualityGateError, match=r"not_null\(dim_vehicles.capacity_kg\): 1"):
        run_pipeline(spark, layout, DAY1)


def test_run_time_must_move_forward(spark, layout):
    first_load(spark, layout)
    run_pipeline(spark, layout, DAY2)
    for run_ts in (DAY1, DAY2):
        with pytest.raises(ValueError, match="not after"):
            run_pipeline(spark, layout, run_ts)


def test_interrupted_build_is_redone(spark, layout, monkeypatch):
    """Dying between the upsert and the progress mark loses and doubles nothing."""
    first_load(spark, layout)
    run_pipeline(spark, layout, DAY1)
    land(spark, layout, DAY2, fleet=[vehicle("V-9")], events=[event("E-5", "V-9"), event("E-6", "V-8")])

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(build, "write_progress", die)
        for minute in range(3):
            with pytest.raises(KeyboardInterrupt):
                run_pipeline(spark, layout, DAY2 + timedelta(minutes=minute))
    run_pipeline(spark, layout, DAY3)
    assert ids(spark, layout) == ["E-1", "E-2", "E-3", "E-5"]
    land(spark, layout, DAY3, fleet=[vehicle("V-8")])
    run_pipeline(spark, layout, DAY3 + timedelta(hours=1))
    assert ids(spark, layout) == ["E-1", "E-2", "E-3", "E-5", "E-6"]


@pytest.mark.parametrize("seed", SEEDS)
def test_incremental_equals_full(spark, tmp_path, seed):
    """Random batches over few keys and a fleet that grows and shrinks: folding new and pending
    rows gives the table that merging all raw rows on every run gives."""
    rng = random.Random(seed)
    stores = [Layout(str(tmp_path / n), fact_buckets=2) for n in ("incremental", "full")]
    for n in range(4):
        run_ts = DAY1 + timedelta(days=n)
        fleet = {f"V-{rng.randrange(5)}" for _ in range(3)}
        events = [
            event(f"E-{rng.randrange(8)}", f"V-{rng.randrange(5)}", temp=str(rng.randrange(20)))
            for _ in range(8)
        ]
        dispatches = [
            order(f"O-{rng.randrange(5)}", weight=str(rng.randrange(9)), destination_lat=rng.choice(["1", "x"]))
            for _ in range(4)
        ]
        for layout in stores:
            extract = vehicles(spark, *[vehicle(v) for v in sorted(fleet)])
            land_masters(layout, {"vehicles": extract}, DAY1.date())
            land(spark, layout, run_ts, crew=[driver("D-1")], events=events, dispatches=dispatches)
            build.build_master(spark, layout, VEHICLES, run_ts)
            gate_and_admit(spark, layout)
            ingest_feeds(spark, layout, run_ts)
            build.build_master(spark, layout, DRIVERS, run_ts)
            build.build_dimensions(spark, layout)
            build.build_fact_telemetry(spark, layout, full=layout is stores[1])
            build.build_fact_orders(spark, layout, full=layout is stores[1])
        for store in stores:
            tables = build.gold_tables(spark, store)
            dims = {n: tables[n] for n in ("dim_vehicles", "dim_drivers")}
            assert rows(gold_tests_by_change(spark, store, dims)) == rows(gold_tests(tables))
    for name in ("fact_telemetry", "fact_orders"):
        incremental, full = (rows(build.fact_table(spark, s, name).read()) for s in stores)
        assert incremental == full


def test_backup_and_metrics(spark, layout):
    first_load(spark, layout)
    run_pipeline(spark, layout, DAY1)
    for _ in range(2):
        results = run_backup(spark, layout, DAY1.date())
        assert [(r.table, r.rows, r.status) for r in results] == [
            ("fact_orders", 2, "exported"),
            ("fact_telemetry", 2, "exported"),
            ("dim_vehicles", 2, "exported"),
            ("dim_drivers", 1, "exported"),
        ]
    older = run_backup(spark, layout, date(2020, 1, 1))
    assert [(r.rows, r.status) for r in older][:2] == [(0, "skipped"), (0, "skipped")]

    history = read_history(spark, layout.history("telemetry"))
    fleet = read_snapshots(spark, layout.snapshots("dim_vehicles"), as_of=DAY1.date())
    assert [tuple(r) for r in fleet_metrics(history, fleet, status="in_transit").collect()] == [
        ("V-1", 1500, 1, 9.0),
        ("V-2", 3000, 1, 5.0),
    ]
    assert temperature_alerts(history).count() == 0
    alerts = temperature_alerts(history, limit=8.0)
    assert [r["record"] for r in as_records(alerts).collect()] == [
        '{"vehicle_id":"V-1","total_alerts":1,"alert_avg_temperature":9.0}'
    ]


def test_history_follows_corrections_and_late_rows(spark, layout):
    first_load(spark, layout)
    run_pipeline(spark, layout, DAY1)
    run_backup(spark, layout, DAY1.date())
    land(
        spark,
        layout,
        DAY2,
        fleet=[vehicle("V-9")],
        events=[event("E-1", "V-2"), event("E-3", "V-2")],
        dispatches=[order("O-1"), order("O-2")],
    )
    run_pipeline(spark, layout, DAY2)
    run_backup(spark, layout, DAY2.date())
    assert read_changed_days(spark, layout) == {}
    telemetry_history = read_history(spark, layout.history("telemetry"))
    assert rows(telemetry_history.select("event_id", "ingestion_day")) == [
        ("E-1", DAY2.date()),
        ("E-2", DAY1.date()),
        ("E-3", DAY2.date()),
    ]
    # Both orders moved on, so their first day holds nothing any more.
    order_history = read_history(spark, layout.history("orders"))
    assert rows(order_history.select("order_id", "ingestion_day")) == [
        ("O-1", DAY2.date()),
        ("O-2", DAY2.date()),
    ]
    dims = read_snapshots(spark, layout.snapshots("dim_vehicles"), as_of=DAY1.date())
    assert dims.count() == 2


def test_a_run_that_dies_after_the_fact_loses_no_changed_day(spark, layout, monkeypatch):
    first_load(spark, layout)
    run_pipeline(spark, layout, DAY1)
    run_backup(spark, layout, DAY1.date())
    land(spark, layout, DAY2, fleet=[vehicle("V-9")], events=[event("E-1", "V-2")])
    with monkeypatch.context() as patch:
        patch.setattr(build, "write_progress", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_pipeline(spark, layout, DAY2)
    run_pipeline(spark, layout, DAY2 + timedelta(minutes=1))
    run_backup(spark, layout, DAY2.date())
    history = read_history(spark, layout.history("telemetry")).select("event_id", "ingestion_day")
    assert rows(history) == [("E-1", DAY2.date()), ("E-2", DAY1.date()), ("E-3", DAY1.date())]


def test_a_run_that_overlaps_a_backup_loses_no_changed_day(spark, layout, monkeypatch):
    """The run logs its days while the backup has read the log, and commits after the backup."""
    first_load(spark, layout)
    run_pipeline(spark, layout, DAY1)
    run_backup(spark, layout, DAY1.date())
    land(spark, layout, DAY2, fleet=[vehicle("V-2")], events=[event("E-1", "V-2")])
    commit = build.KeyedTable._commit

    def late(table, *args):
        if table.path.endswith("fact_telemetry"):
            run_backup(spark, layout, DAY1.date())
            assert DAY1.date() in read_changed_days(spark, layout)["fact_telemetry"]
        commit(table, *args)

    with monkeypatch.context() as patch:
        patch.setattr(build.KeyedTable, "_commit", late)
        patch.setattr(build.KeyedTable, "fold", lambda *_: 0)
        run_pipeline(spark, layout, DAY2)
    run_backup(spark, layout, DAY2.date())
    assert read_changed_days(spark, layout) == {}
    history = read_history(spark, layout.history("telemetry")).select("event_id", "ingestion_day")
    assert rows(history) == [("E-1", DAY2.date()), ("E-3", DAY1.date())]


def test_facts_of_a_departed_vehicle_stay_and_fail_the_reference_test(spark, layout):
    first_load(spark, layout)
    run_pipeline(spark, layout, DAY1)
    land_masters(layout, {"vehicles": vehicles(spark, vehicle("V-1"))}, DAY1.date())
    with pytest.raises(QualityGateError, match=r"relationships\(fact_telemetry.vehicle_id\): 1"):
        run_pipeline(spark, layout, DAY2)
    assert ids(spark, layout) == ["E-1", "E-3"]


def test_one_failing_table_does_not_stop_the_others(spark, tmp_path):
    def broken():
        raise RuntimeError("no such table")

    tables = {
        "broken": (broken, str(tmp_path / "broken")),
        "fine": (lambda: spark.range(3), str(tmp_path / "fine")),
    }
    with pytest.raises(BackupError, match="broken: no such table") as caught:
        export_tables(spark, tables, DAY1.date())
    assert [(r.table, r.status, r.rows) for r in caught.value.results] == [
        ("broken", "failed", 0),
        ("fine", "exported", 3),
    ]


def test_models_as_sql_views(spark, layout):
    first_load(spark, layout)
    run_pipeline(spark, layout, DAY1)
    assert len(register_views(spark, layout)) == 8
    got = spark.sql(
        """
        select d.capacity_kg, count(*) as n
        from fact_telemetry f join dim_vehicles d using (vehicle_id)
        where trim(upper(f.delivery_status)) = trim(upper(:status))
        group by d.capacity_kg
        """,
        args={"status": " In_Transit"},
    )
    assert rows(got) == [(1500, 1), (3000, 1)]
    assert spark.sql("select event_id from stg_telemetry").count() == 2


def test_actions_side_by_side(spark):
    assert run_together(spark, [lambda n=n: spark.range(n).count() for n in range(6)]) == [*range(6)]
    done = []

    def fail():
        raise RuntimeError("first")

    with pytest.raises(RuntimeError, match="first"):
        run_together(spark, [fail, lambda: done.append(spark.range(5).count())])
    assert done == [5]
