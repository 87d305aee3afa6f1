from __future__ import annotations

import json
from datetime import date, datetime
from pathlib import Path
from urllib.parse import unquote

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from terrace.schemas import TELEMETRY, VEHICLES
from terrace.sources import jdbc
from terrace.sources.guards import EmptyInputError, has_rows, require_rows
from terrace.sources.json_batches import (
    SOURCE_DAY_COLUMN,
    array_files,
    land_batch,
    land_daily_snapshot,
    read_json_batches,
    split_corrupt,
    with_source_day,
)
from terrace.sources.versioned import is_published, publish, read_current, versions
from tests.helpers import event, plan, rows, telemetry, vehicle, vehicles, write_array, write_text


def read(spark, path, **options):
    return split_corrupt(read_json_batches(spark, str(path), VEHICLES.bronze_schema, **options))


def test_arrays_lines_and_empty_files(spark, tmp_path):
    write_array(tmp_path / "b" / "one.json", [vehicle("V-1"), vehicle("V-2", capacity=3000)])
    write_text(
        tmp_path / "b" / "deeper" / "lines.json",
        "\n".join(json.dumps(vehicle(v)) for v in ("V-3", "V-4")),
    )
    write_text(tmp_path / "b" / "none.json", "[]")
    good, bad = read(spark, tmp_path / "b")
    assert rows(good.select("vehicle_id", "capacity_kg")) == [
        ("V-1", "1500"),
        ("V-2", "3000"),
        ("V-3", "1500"),
        ("V-4", "1500"),
    ]
    assert bad.count() == 0


def test_lines_are_read_and_parsed_once(spark, tmp_path):
    """Whatever is asked of a record's fields: no condition on them parses the text again."""
    write_text(tmp_path / "b" / "lines.json", "\n".join(json.dumps(vehicle(v)) for v in ("V-1", "V-2")))
    found = read_json_batches(spark, str(tmp_path / "b"), VEHICLES.bronze_schema)
    asked = found.where("_corrupt_record is not null or (vehicle_id = 'V-2' and status is not null)")
    physical = plan(asked).partition("== Physical Plan ==")[2]
    assert physical.count("FileScan text") == 1
    assert not [line for line in physical.splitlines() if "Filter" in line and "from_json" in line]
    assert rows(asked.select("vehicle_id")) == [("V-2",)]


def test_forms_and_separators_of_lines_in_one_file(spark, tmp_path):
    one, two, three = (json.dumps(vehicle(v)) for v in ("V-1", "V-2", "V-3"))
    texts = [one + ",", two + ", \t", f"[{three}, null]", "[]", "[oops", '{"vehicle_id": ', "null", one + ",,"]
    write_text(tmp_path / "b" / "mixed.json", "\n".join(texts))
    good, bad = read(spark, tmp_path / "b")
    assert rows(good.where("vehicle_id is not null").select("vehicle_id")) == [("V-1",), ("V-1",), ("V-2",), ("V-3",)]
    assert sorted(r[0] for r in bad.select("_corrupt_record").collect()) == ["[oops", "null", '{"vehicle_id": ']


def test_only_an_empty_array(spark, tmp_path):
    write_text(tmp_path / "b" / "none.json", "[]")
    good, bad = read(spark, tmp_path / "b")
    assert not has_rows(good) and not has_rows(bad)


def test_each_file_is_read_in_its_own_form(spark, tmp_path):
    def lines(*ids):
        return [json.dumps(vehicle(v)) for v in ids]

    folder = tmp_path / "b"
    write_array(folder / "pretty.json", [vehicle("P-1"), vehicle("P}2,{")], indent=2)
    write_text(folder / "line_each.json", "[\n" + ",\n".join(lines("E-1", "E-2")) + "\n]\n")
    write_text(folder / "arrays.json", "\n".join(f"[{', '.join(lines(*p))}]" for p in (["A-1"], ["A-2", "A-3"])))
    write_text(folder / "lines.json", "\r\n".join(lines("L-1", "L-2")))
    write_text(folder / "empty.json", "")
    good, bad = read(spark, folder)
    found = sorted(r["vehicle_id"] for r in good.collect())
    assert found == ["A-1", "A-2", "A-3", "E-1", "E-2", "L-1", "L-2", "P-1", "P}2,{"]
    assert bad.count() == 0


def test_a_large_line_file_is_read_by_many_tasks(spark, tmp_path):
    lines = "\n".join(json.dumps(vehicle(f"V-{n}")) for n in range(20_000))
    write_text(tmp_path / "b" / "lines.json", lines)
    write_array(tmp_path / "b" / "array.json", [vehicle("A-1")], indent=1)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        good, bad = read(spark, tmp_path / "b")
        assert good.count() == 20_001 and bad.count() == 0
        assert good.select(F.spark_partition_id()).distinct().count() >= 5
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_arrays_are_told_from_lines(spark, tmp_path):
    folder = tmp_path / "b"
    one = json.dumps(vehicle("V-1"))
    write_text(folder / "flat.json", f"\n  [{one},{one}]\n")
    write_text(folder / "a b%20c.json", f"[\n{one}\n]")
    write_text(folder / "arrays.json", f"[{one}]\n[{one}]")
    write_text(folder / "lines.json", f"{one}\n[{one}]\n")
    write_text(folder / "blank.json", " \n\n")
    found = sorted(unquote(f).rsplit("/", 1)[1] for f in array_files(spark, str(folder)))
    assert found == ["a b%20c.json", "flat.json"]
    good, bad = read(spark, folder)
    assert good.count() == 7 and bad.count() == 0


def test_a_cut_array_is_read_by_its_lines(spark, tmp_path):
    lines = [json.dumps(vehicle(f"V-{n}")) for n in range(3)]
    write_text(tmp_path / "b" / "cut.json", "[\n" + ",\n".join(lines) + ',\n{"vehicle_id": "V-3", "sta')
    good, bad = read(spark, tmp_path / "b")
    assert sorted(r["vehicle_id"] for r in good.collect()) == ["V-0", "V-1", "V-2"]
    assert sorted(r["_corrupt_record"] for r in bad.collect()) == ["[", '{"vehicle_id": "V-3", "sta']
    assert bad.count() == 2 and not bad.isEmpty()


def test_records_that_do_not_parse_are_quarantined_alone(spark, tmp_path):
    write_array(tmp_path / "b" / "one.json", [vehicle("V-1")])
    write_text(tmp_path / "b" / "cut.json", '[{"vehicle_id":"V-2"},{"vehicle_id"')
    write_text(tmp_path / "b" / "mixed.json", '{"vehicle_id":"V-3"}\nnoise\n{"vehicle_id":"V-4"}\nnoise')
    good, bad = read(spark, tmp_path / "b")
    assert sorted(r["vehicle_id"] for r in good.collect()) == ["V-1", "V-3", "V-4"]
    found = sorted(r["_corrupt_record"] for r in bad.collect())
    assert found == ['[{"vehicle_id":"V-2"},{"vehicle_id"', "noise", "noise"]


def test_extra_fields_are_ignored_and_missing_ones_null(spark, tmp_path):
    write_array(tmp_path / "b" / "one.json", [{"vehicle_id": "V-1", "colour": "red"}])
    good, _ = read(spark, tmp_path / "b")
    assert rows(good) == [("V-1", None, None, None)]


def test_missing_path(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read(spark, tmp_path / "absent")
    good, _ = read(spark, tmp_path / "absent", required=False)
    assert good.columns == list(VEHICLES.columns) and good.count() == 0


def test_daily_snapshot_replaces_the_same_day_only(spark, tmp_path):
    prefix = str(tmp_path / "vehicles")
    land_daily_snapshot(vehicles(spark, vehicle("V-1")), prefix, date(2024, 1, 1))
    land_daily_snapshot(vehicles(spark, vehicle("V-2")), prefix, date(2024, 1, 2))
    land_daily_snapshot(vehicles(spark, vehicle("V-3")), prefix, date(2024, 1, 2))
    dated = with_source_day(
        read_json_batches(spark, prefix, VEHICLES.bronze_schema, with_path=True)
    )
    assert rows(dated.select("vehicle_id", SOURCE_DAY_COLUMN)) == [
        ("V-1", "20240101"),
        ("V-3", "20240102"),
    ]


def test_day_of_a_single_file_extract(spark, tmp_path):
    write_array(tmp_path / "vehicles" / "vehicles_20240105.json", [vehicle("V-1")])
    landed = read_json_batches(
        spark, str(tmp_path / "vehicles"), VEHICLES.bronze_schema, with_path=True
    )
    assert with_source_day(landed).first()[SOURCE_DAY_COLUMN] == "20240105"


def test_batches_are_immutable(spark, tmp_path):
    prefix, at = str(tmp_path / "telemetry"), datetime(2024, 1, 1, 10, 5)
    batch = telemetry(spark, event("E-1", "V-1"))
    assert land_batch(batch, prefix, at).endswith("/batch_20240101_100500")
    with pytest.raises(AnalysisException):
        land_batch(batch, prefix, at)
    landed = read_json_batches(spark, prefix, TELEMETRY.bronze_schema)
    assert rows(landed.select(*TELEMETRY.columns)) == rows(batch)


def test_landings_of_more_than_a_file_are_gzipped(spark, tmp_path):
    batch = telemetry(spark, *[event(f"E-{i}", f"V-{i % 3}", speed_kmh=None) for i in range(50)])
    for limit, kept, suffix in ((49, 2, ".json.gz"), (50, 1, ".json")):
        prefix, at = str(tmp_path / str(limit) / "telemetry"), datetime(2024, 1, 1, 10, 5)
        folder = land_batch(batch.coalesce(1), prefix, at, max_records_per_file=limit)
        names = [f.name for f in Path(folder).glob("part-*")]
        assert len(names) == kept and all(n.endswith(suffix) for n in names)
        found = read_json_batches(spark, prefix, TELEMETRY.bronze_schema, with_path=True)
        good, bad = split_corrupt(found)
        assert rows(good.select(*TELEMETRY.columns)) == rows(batch) and bad.count() == 0
        assert good.select("_source_path").distinct().count() == kept


def test_empty_landing_is_refused(spark, tmp_path):
    with pytest.raises(EmptyInputError):
        land_batch(telemetry(spark), str(tmp_path / "t"), datetime(2024, 1, 1))
    with pytest.raises(EmptyInputError):
        require_rows(telemetry(spark), "telemetry")


def test_published_versions(spark, tmp_path):
    path = str(tmp_path / "dim")
    assert not is_published(spark, path)
    with pytest.raises(FileNotFoundError):
        read_current(spark, path)
    for n in range(4):
        publish(spark.range(n + 1), path, keep_seconds=0)
    assert read_current(spark, path).count() == 4
    assert len(versions(spark, path)) == 2
    # Versions that a reader may have open stay for their time.
    for n in range(3):
        publish(spark.range(n + 1), path)
    assert len(versions(spark, path)) == 5


def test_unfinished_version_is_not_read(spark, tmp_path):
    path = str(tmp_path / "dim")
    publish(spark.range(3), path)
    write_text(tmp_path / "dim" / "version_99999999999999999999_dead" / "part-0.parquet", "junk")
    assert read_current(spark, path).count() == 3


def test_leftovers_of_dead_builds_expire(spark, tmp_path):
    path = str(tmp_path / "dim")
    write_text(tmp_path / "dim" / "version_00000000000000000001_dead" / "part-0.parquet", "junk")
    publish(spark.range(3), path)
    assert [f.name for f in (tmp_path / "dim").iterdir()] == versions(spark, path)


def test_table_can_be_rebuilt_from_itself(spark, tmp_path):
    path = str(tmp_path / "dim")
    publish(spark.range(3), path)
    publish(read_current(spark, path).unionByName(spark.range(2)), path)
    assert read_current(spark, path).count() == 5


def test_jdbc_options():
    split = jdbc.Split("id", "0", "1000000", 64)
    options = jdbc.read_options("jdbc:x", "fact_orders", {"user": "u"}, split)
    assert options["dbtable"] == "fact_orders" and options["user"] == "u"
    assert (options["partitionColumn"], options["numPartitions"]) == ("id", "64")
    assert "partitionColumn" not in jdbc.read_options("jdbc:x", "t")
    assert jdbc.write_options("jdbc:x", "t", "overwrite")["truncate"] == "true"
    assert jdbc.write_options("jdbc:x", "t", "append")["truncate"] == "false"
    with pytest.raises(ValueError, match="ignore"):
        jdbc.write_options("jdbc:x", "t", "ignore")
