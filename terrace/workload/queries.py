"""One callable per operator or pipeline: (spark, table folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions.columns import (
    as_float,
    as_int,
    as_timestamp,
    band,
    instant,
    normkey,
    prior_day,
    round_scaled,
    with_stored_keys,
)
from terrace.layout import Layout
from terrace.operators import joins, quality, snapshots
from terrace.operators.dedup import distinct_by_key, latest_version
from terrace.operators.incremental import changes_since, watermark
from terrace.operators.keyed_table import KeyedTable
from terrace.plans import metrics, models
from terrace.plans.backup import export_tables, run_backup
from terrace.plans.build import (
    build_dimensions,
    build_fact_orders,
    build_fact_telemetry,
    build_master,
    fact_table,
)
from terrace.plans.gates import TELEMETRY_EXPECTATIONS, gate_and_admit, judged
from terrace.plans.gates import gold_tests as run_gold_tests
from terrace.plans.pipeline import ingest_feeds, land_batches, land_masters
from terrace.plans.silver import (
    clean_drivers,
    clean_orders,
    clean_telemetry,
    clean_vehicles,
)
from terrace.plans.views import register_views
from terrace.schemas import DRIVERS, ORDERS, TELEMETRY, VEHICLES, Entity
from terrace.sources.json_batches import (
    land_batch,
    land_daily_snapshot,
    read_json_batches,
    split_corrupt,
    with_source_day,
)
from terrace.sources.versioned import publish, read_current
from terrace.staging import new_folder
from terrace.streaming.ingest import ResendSuppression, ingest_available, read_raw
from terrace.workload import inputs
from terrace.workload.inputs import comparable, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

CUTOFF = "1998-01-01"
FIRST_DAY, SECOND_DAY = date(2024, 1, 1), date(2024, 1, 2)
FIRST_RUN, SECOND_RUN = datetime(2024, 1, 1, 12), datetime(2024, 1, 2, 12)


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _before(df: DataFrame, column: str, text: str = CUTOFF) -> DataFrame:
    return df.where(F.col(column) < instant(text, df.schema[column].dataType))


def _from(df: DataFrame, column: str, text: str = CUTOFF) -> DataFrame:
    return df.where(F.col(column) >= instant(text, df.schema[column].dataType))


# --- metrics ------------------------------------------------------------------------


def _fleet_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn(
        "vehicle", F.concat(F.lit("customer#"), F.lpad(F.col("user_id").cast("string"), 9, "0"))
    )


_FLEET = {
    "vehicle_column": "c_name",
    "capacity_column": "c_acctbal",
    "time_column": "ts",
    "temperature_column": "value",
    "status_column": "event_type",
    "fact_vehicle_column": "vehicle",
}


@query
def fleet_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.fleet_metrics(
        _fleet_events(spark, sf_dir), table(spark, sf_dir, "customer"), **_FLEET
    )


@query
def fleet_metrics_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.fleet_metrics(
        _fleet_events(spark, sf_dir), table(spark, sf_dir, "customer"), status=" Error ", **_FLEET
    )


@query
def fleet_metrics_all_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reading every snapshot multiplies the counts by the number of snapshots."""
    root = new_folder(spark, "snapshots")
    customers = table(spark, sf_dir, "customer")
    for day in (FIRST_DAY, SECOND_DAY):
        snapshots.export_snapshot(customers, root, day)
    fleet = snapshots.read_snapshots(spark, root, as_of=None)
    return metrics.fleet_metrics(_fleet_events(spark, sf_dir), fleet, **_FLEET)


@query
def fleet_metrics_cold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cold history with stored keys, one dimension snapshot, a status pushed to the scan."""
    history, dims = new_folder(spark, "history"), new_folder(spark, "snapshots")
    events = with_stored_keys(_fleet_events(spark, sf_dir), "vehicle", "event_type")
    snapshots.write_partitioned(
        events.withColumn("ingestion_day", F.to_date("ts")), history, "ingestion_day"
    )
    customers = with_stored_keys(table(spark, sf_dir, "customer"), "c_name")
    for day in (FIRST_DAY, SECOND_DAY):
        snapshots.export_snapshot(customers, dims, day)
    return metrics.fleet_metrics(
        snapshots.read_history(spark, history),
        snapshots.read_snapshots(spark, dims, as_of=SECOND_DAY),
        status="view",
        **_FLEET,
    )


@query
def temperature_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.temperature_alerts(
        table(spark, sf_dir, "events"), vehicle_column="user_id", temperature_column="value"
    )


@query
def alert_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alerts as JSON text, with a limit of its own."""
    alerts = metrics.temperature_alerts(
        table(spark, sf_dir, "events"), 100.0, vehicle_column="user_id", temperature_column="value"
    )
    return metrics.as_records(alerts.drop("alert_avg_temperature"))


# --- projections, casts, predicates ---------------------------------------------------


@query
def temperature_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", "value", band("value").alias("temperature_alert_status")
    )


@query
def band_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .groupBy(band("value").alias("temperature_alert_status"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query
def dim_filter_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .where(F.col("o_orderstatus") == "F")
        .select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_orderstatus").alias("order_status"),
            F.col("o_orderdate").alias("order_created_at"),
        )
    )


@query
def key_normalisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Case and outer spaces differ from row to row; one key per type remains."""
    events = table(spark, sf_dir, "events")
    spelled = F.when(F.col("value") > 34, F.concat(F.lit("  "), F.upper("event_type"))).otherwise(
        F.concat(F.initcap("event_type"), F.lit(" "))
    )
    return events.groupBy(normkey(spelled).alias("status_key")).agg(
        F.count(F.lit(1)).alias("n"), round_scaled(F.avg("value")).alias("avg_value")
    )


@query
def type_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers as text, with bad text among them."""
    text = F.when(F.col("l_returnflag") == "R", F.concat("l_returnflag", F.lit("?"))).otherwise(
        F.col("l_extendedprice").cast("string")
    )
    return comparable(
        table(spark, sf_dir, "lineitem")
        .withColumn("text", text)
        .select(
            "l_orderkey",
            "l_linenumber",
            as_float("text").alias("as_float"),
            as_int("text").alias("as_int"),
            as_float("l_discount").alias("discount_float"),
        )
    )


@query
def timestamp_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO text with an offset, with bad text among it."""
    local = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".250000+02:00"))
    text = F.when(F.col("o_orderstatus") == "P", F.lit("not a time")).otherwise(local)
    return comparable(
        table(spark, sf_dir, "orders")
        .withColumn("text", text)
        .select("o_orderkey", as_timestamp("text").alias("created_at"))
    )


# --- dedup and joins --------------------------------------------------------------------

_LINE_KEY = ["l_orderkey", "l_linenumber"]


def _latest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return latest_version(lines, _LINE_KEY, ["l_shipdate", "l_partkey", "l_suppkey"])


def _good_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").where(F.col("s_acctbal") > 0)


@query
def latest_line_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _latest_lines(spark, sf_dir)


@query
def latest_then_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dedup first: a latest version naming an unknown parent does not fall back."""
    return joins.referential_filter(
        _latest_lines(spark, sf_dir), _good_suppliers(spark, sf_dir), "l_suppkey", "s_suppkey"
    )


@query
def distinct_orders_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct by key where one key is null and holds a fifth of the rows."""
    keyed = table(spark, sf_dir, "orders").withColumn(
        "priority", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
    )
    return distinct_by_key(keyed, ["priority"])


@query
def referential_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return joins.referential_filter(
        lines, _good_suppliers(spark, sf_dir), "l_suppkey", "s_suppkey"
    )


@query
def ref_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.orphan_counts(
        table(spark, sf_dir, "lineitem"), _good_suppliers(spark, sf_dir), "l_suppkey", "s_suppkey"
    )


# --- quality ----------------------------------------------------------------------------


@query
def unique_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), "l_orderkey")


@query
def expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null and range checks in one pass; the key is null for one event type."""
    events = table(spark, sf_dir, "events").withColumn(
        "user_id", F.when(F.col("event_type") != "view", F.col("user_id"))
    )
    return quality.evaluate(
        events,
        [
            quality.expect_not_null("user_id"),
            quality.expect_not_null("ts"),
            quality.expect_between("value", -50.0, 100.0),
        ],
    )


@query
def telemetry_gate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze gate's checks on landed text: a null, an unreadable and an extreme value."""
    feed = inputs.telemetry(spark, sf_dir)
    hit = F.col("delivery_status")
    spoiled = feed.withColumns(
        {
            "latitude": F.when(hit != "R", F.col("latitude")),
            "longitude": F.when(hit == "A", F.lit("east")).otherwise(F.col("longitude").cast("string")),
            "cargo_temp_c": F.when(hit == "N", F.col("cargo_temp_c") * 4).otherwise(
                F.col("cargo_temp_c")
            ),
        }
    )
    landed = _landed(spark, spoiled, TELEMETRY)
    return quality.evaluate(judged(landed), TELEMETRY_EXPECTATIONS)


@query
def gold_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared tests on tables that break some of them."""
    vehicles = clean_vehicles(inputs.vehicles(spark, sf_dir)).where(F.col("capacity_kg") > 0)
    return run_gold_tests(
        {
            "dim_vehicles": models.dim_vehicles(models.stg_vehicles(vehicles)),
            "dim_drivers": models.dim_drivers(
                models.stg_drivers(clean_drivers(inputs.drivers(spark, sf_dir)))
            ),
            "fact_telemetry": inputs.versioned_telemetry(spark, sf_dir),
            "fact_orders": inputs.versioned_orders(spark, sf_dir).withColumn(
                "destination_lat", F.when(F.col("status") != "P", F.col("destination_lat"))
            ),
        }
    )


# --- silver and models --------------------------------------------------------------------


def _unstamped(df: DataFrame) -> DataFrame:
    return comparable(df.drop("ingestion_date"))


def _landed(spark: SparkSession, df: DataFrame, entity: Entity) -> DataFrame:
    path = new_folder(spark, entity.name)
    land_batch(df, path, FIRST_RUN)
    parsed, _ = split_corrupt(read_json_batches(spark, path, entity.bronze_schema))
    return parsed


@query
def clean_vehicles_newest_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two daily extracts; the newer one gives the capacity where it names the vehicle."""
    vehicles = inputs.vehicles(spark, sf_dir)
    prefix = new_folder(spark, "vehicles")
    land_daily_snapshot(vehicles, prefix, FIRST_DAY)
    newer = vehicles.where(F.col("capacity_kg") > 0).withColumn(
        "capacity_kg", F.col("capacity_kg") + 1000
    )
    land_daily_snapshot(newer, prefix, SECOND_DAY)
    landed = with_source_day(
        read_json_batches(spark, prefix, VEHICLES.bronze_schema, with_path=True)
    )
    parsed, _ = split_corrupt(landed)
    return _unstamped(clean_vehicles(parsed))


@query
def clean_drivers_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unstamped(clean_drivers(_landed(spark, inputs.drivers(spark, sf_dir), DRIVERS)))


@query
def clean_telemetry_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a vehicle drop out before the dedup."""
    feed = inputs.telemetry(spark, sf_dir).withColumn(
        "vehicle_id", F.when(F.col("delivery_status") != "R", F.col("vehicle_id"))
    )
    return _unstamped(clean_telemetry(_landed(spark, feed, TELEMETRY)))


@query
def clean_orders_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unstamped(clean_orders(_landed(spark, inputs.orders(spark, sf_dir), ORDERS)))


@query
def stg_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unstamped(models.stg_vehicles(clean_vehicles(inputs.vehicles(spark, sf_dir))))


@query
def stg_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unstamped(models.stg_drivers(clean_drivers(inputs.drivers(spark, sf_dir))))


@query
def stg_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = inputs.vehicles(spark, sf_dir).where(F.col("capacity_kg") > 0)
    return comparable(models.stg_telemetry(inputs.versioned_telemetry(spark, sf_dir), known))


@query
def stg_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(models.stg_orders(inputs.versioned_orders(spark, sf_dir)))


@query
def dim_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rebuilt twice as a published table; readers see the newer build."""
    path = new_folder(spark, "dim_vehicles")
    raw = clean_vehicles(inputs.vehicles(spark, sf_dir))
    dim = models.dim_vehicles(models.stg_vehicles(raw))
    publish(dim.where(F.col("capacity_kg") > 0), path)
    publish(dim, path)
    return read_current(spark, path)


@query
def dim_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = clean_drivers(inputs.drivers(spark, sf_dir))
    return models.dim_drivers(models.stg_drivers(raw))


def _two_loads(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    early = F.substring(column, 1, 10) < CUTOFF
    return df.where(early), df.where(~early)


def _ingest(spark: SparkSession, layout: Layout, entity: Entity, run_ts: datetime) -> None:
    ingest_available(
        spark,
        layout.bronze(entity.name),
        layout.raw(entity.name),
        layout.state(f"ingest_{entity.name}"),
        entity,
        run_ts=run_ts,
    )


@query
def fact_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing to fact in two runs. Vehicles of the second extract were unknown in the first
    run, so their events wait and are folded in without reading raw history again."""
    layout = Layout(new_folder(spark, "fleet"), fact_buckets=8)
    vehicles = inputs.vehicles(spark, sf_dir)
    loads = _two_loads(inputs.telemetry(spark, sf_dir), "timestamp")
    fleets = (vehicles.where("capacity_kg > 0"), vehicles.where("capacity_kg > -500"))
    for load, fleet, run_ts in zip(loads, fleets, (FIRST_RUN, SECOND_RUN), strict=True):
        land_masters(layout, {"vehicles": fleet}, run_ts.date())
        land_batches(layout, {"telemetry": load}, run_ts)
        build_master(spark, layout, VEHICLES, run_ts)
        _ingest(spark, layout, TELEMETRY, run_ts)
        build_fact_telemetry(spark, layout)
    return comparable(fact_table(spark, layout, "fact_telemetry").read())


@query
def fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing to fact in two runs; later orders of a key replace earlier ones."""
    layout = Layout(new_folder(spark, "fleet"), fact_buckets=8)
    for load, run_ts in zip(
        _two_loads(inputs.orders(spark, sf_dir), "created_at"), (FIRST_RUN, SECOND_RUN), strict=True
    ):
        land_batches(layout, {"orders": load}, run_ts)
        _ingest(spark, layout, ORDERS, run_ts)
        build_fact_orders(spark, layout)
    return comparable(fact_table(spark, layout, "fact_orders").read())


# --- incremental tables and cold history ----------------------------------------------------


@query
def watermark_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    filled = watermark(_before(orders, "o_orderdate"), "o_orderdate")
    empty = watermark(_before(orders, "o_orderdate", "1800-01-01"), "o_orderdate")
    return filled.select(F.lit("filled").alias("target"), "watermark").unionByName(
        empty.select(F.lit("empty").alias("target"), "watermark")
    )


@query
def watermark_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return changes_since(orders, _before(orders, "o_orderdate"), "o_orderdate")


@query
def watermark_first_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a target all rows are changes, and make it; a second run finds none."""
    orders = table(spark, sf_dir, "orders")
    target = KeyedTable(spark, new_folder(spark, "orders"), "o_orderkey", buckets=8)
    for _ in range(2):
        stored = target.read() if target.exists() else None
        target.upsert(changes_since(orders, stored, "o_orderdate"))
    return target.read()


@query
def keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines up to a day, then the later ones over them; the second load runs twice."""
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "line_id", F.concat_ws("-", "l_orderkey", "l_linenumber")
    )
    newest_first = ["l_shipdate", "l_partkey", "l_suppkey"]
    target = KeyedTable(spark, new_folder(spark, "lines"), "line_id", buckets=8)
    target.upsert(_before(lines, "l_shipdate"), newest_first)
    for _ in range(2):
        target.upsert(_from(lines, "l_shipdate"), newest_first)
    return target.read()


@query
def raw_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches accumulate in one raw table; repeated keys stay until staging."""
    layout = Layout(new_folder(spark, "raw"))
    for load, run_ts in zip(
        _two_loads(inputs.orders(spark, sf_dir), "created_at"), (FIRST_RUN, SECOND_RUN), strict=True
    ):
        land_batches(layout, {"orders": load}, run_ts)
        _ingest(spark, layout, ORDERS, run_ts)
    return comparable(read_raw(spark, layout.raw("orders"), ORDERS)).drop("ingestion_date")


@query
def d1_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day before the run date, exported twice and read back once."""
    path = new_folder(spark, "events_history")
    day = prior_day(date(2024, 1, 16))
    for _ in range(2):
        snapshots.export_increment(table(spark, sf_dir, "events"), path, day, column="ts")
    return snapshots.read_history(spark, path, day, day).drop("ingestion_day")


@query
def partitioned_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All partitions written, then some rewritten; the others stay as they were."""
    path = new_folder(spark, "orders_by_status")
    orders = table(spark, sf_dir, "orders")
    snapshots.write_partitioned(orders, path, "o_orderstatus")
    changed = orders.where(F.col("o_orderstatus") == "F").withColumn(
        "o_totalprice", -F.col("o_totalprice")
    )
    snapshots.write_partitioned(changed, path, "o_orderstatus")
    return spark.read.parquet(path)


@query
def snapshot_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "customer_snapshots")
    customers = table(spark, sf_dir, "customer")
    older = customers.withColumn("c_acctbal", F.col("c_acctbal") + 1)
    snapshots.export_snapshot(older, path, FIRST_DAY)
    snapshots.export_snapshot(customers, path, SECOND_DAY)
    return snapshots.read_snapshots(spark, path, as_of=FIRST_DAY)


@query
def backup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two increments and two snapshots in one export, counted where they were written."""
    root = new_folder(spark, "cold")
    day = date(1998, 1, 1)
    known = clean_vehicles(inputs.vehicles(spark, sf_dir))
    drivers = clean_drivers(inputs.drivers(spark, sf_dir))
    tables = {
        "fact_orders": lambda: models.stg_orders(inputs.versioned_orders(spark, sf_dir)),
        "fact_telemetry": lambda: models.fact_telemetry(
            models.stg_telemetry(inputs.versioned_telemetry(spark, sf_dir), known)
        ),
        "dim_vehicles": lambda: models.dim_vehicles(models.stg_vehicles(known)),
        "dim_drivers": lambda: models.dim_drivers(models.stg_drivers(drivers)),
    }
    targets = {n: (open_it, f"{root}/{n}") for n, open_it in tables.items()}
    results = export_tables(spark, targets, day)
    exported = None
    for result in results:
        if result.status != "exported":
            continue
        part = "ingestion_day" if result.table.startswith("fact_") else "snapshot_date"
        rows = spark.read.parquet(result.path).groupBy(F.col(part).alias("day")).agg(
            F.count(F.lit(1)).alias("n")
        )
        counted = rows.select(F.lit(result.table).alias("table_name"), "day", "n")
        exported = counted if exported is None else exported.unionByName(counted)
    return exported


# --- landing and streaming ------------------------------------------------------------------


@query
def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed as JSON, read back with a declared schema, nothing lost."""
    path = new_folder(spark, "orders_json")
    orders = table(spark, sf_dir, "orders")
    land_batch(orders, path, FIRST_RUN, max_records_per_file=10_000)
    parsed, _ = split_corrupt(read_json_batches(spark, path, orders.schema))
    return parsed


@query
def json_arrays_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as arrays printed over several lines, one array per file."""
    path = new_folder(spark, "orders_arrays")
    orders = table(spark, sf_dir, "orders")
    files = F.ceil(F.lit(orders.count() / 5_000)).cast("int")
    grouped = orders.groupBy(F.pmod(F.xxhash64("o_orderkey"), files)).agg(
        F.collect_list(F.struct(*orders.columns)).alias("records")
    )
    text = grouped.select(F.to_json("records", {"pretty": "true"}).alias("value"))
    text.write.option("maxRecordsPerFile", 1).text(path)
    parsed, _ = split_corrupt(read_json_batches(spark, path, orders.schema))
    return parsed


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches through the file stream, the second picked up by a second run."""
    layout = Layout(new_folder(spark, "stream"))
    for load, run_ts in zip(
        _two_loads(inputs.telemetry(spark, sf_dir), "timestamp"),
        (FIRST_RUN, SECOND_RUN),
        strict=True,
    ):
        land_batches(layout, {"telemetry": load}, run_ts)
        _ingest(spark, layout, TELEMETRY, run_ts)
    return comparable(read_raw(spark, layout.raw("telemetry"), TELEMETRY))


@query
def stream_resend_suppression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later events first, then all: repeats are dropped, and what arrives first arrives,
    though it is weeks later than the delay."""
    layout = Layout(new_folder(spark, "resend"))
    events = table(spark, sf_dir, "events").select(
        F.concat(F.lit("EVT-"), "event_id").alias("event_id"),
        F.concat(F.lit("V-"), "user_id").alias("vehicle_id"),
        inputs.iso("ts").alias("timestamp"),
        F.lit(None).cast("double").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"),
        F.col("event_type").alias("delivery_status"),
        F.col("value").alias("cargo_temp_c"),
        F.lit(None).cast("double").alias("speed_kmh"),
    )
    late = F.substring("timestamp", 1, 10) >= "2024-01-15"
    for load, run_ts in ((events.where(late), FIRST_RUN), (events, SECOND_RUN)):
        land_batches(layout, {"telemetry": load}, run_ts)
        ingest_available(
            spark,
            layout.bronze("telemetry"),
            layout.raw("telemetry"),
            layout.state("ingest_telemetry"),
            TELEMETRY,
            run_ts=run_ts,
            suppression=ResendSuppression("timestamp", "1 hour"),
        )
    rows = read_raw(spark, layout.raw("telemetry"), TELEMETRY)
    return comparable(
        rows.select("event_id", "vehicle_id", "timestamp", "delivery_status", "cargo_temp_c")
    )


# --- the fleet's lake ---------------------------------------------------------------------


def _lake(spark: SparkSession, sf_dir: str, label: str) -> Layout:
    """Masters, and the feeds' rows up to a day, from landing to gold."""
    layout = Layout(new_folder(spark, label), fact_buckets=8)
    masters = {"vehicles": inputs.vehicles(spark, sf_dir), "drivers": inputs.drivers(spark, sf_dir)}
    land_masters(layout, masters, FIRST_RUN.date())
    for entity in (VEHICLES, DRIVERS):
        build_master(spark, layout, entity, FIRST_RUN)
    build_dimensions(spark, layout)
    _load_feeds(spark, sf_dir, layout, 0)
    return layout


def _load_feeds(spark: SparkSession, sf_dir: str, layout: Layout, n: int) -> None:
    """The feeds' rows up to a day (0) or from it on (1)."""
    run_ts = (FIRST_RUN, SECOND_RUN)[n]
    telemetry = _two_loads(inputs.telemetry(spark, sf_dir), "timestamp")[n]
    orders = _two_loads(inputs.orders(spark, sf_dir), "created_at")[n]
    land_batches(layout, {"telemetry": telemetry, "orders": orders}, run_ts)
    gate_and_admit(spark, layout)
    ingest_feeds(spark, layout, run_ts)
    build_fact_telemetry(spark, layout)
    build_fact_orders(spark, layout)


@query
def gate_then_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that passes the gate and one that does not: only the first is ingested."""
    layout = Layout(new_folder(spark, "gate"))
    good, bad = _two_loads(inputs.telemetry(spark, sf_dir), "timestamp")
    land_batches(layout, {"telemetry": good, "orders": inputs.orders(spark, sf_dir)}, FIRST_RUN)
    gate_and_admit(spark, layout)
    land_batches(layout, {"telemetry": bad.withColumn("cargo_temp_c", F.col("cargo_temp_c") * 40)}, SECOND_RUN)
    try:
        gate_and_admit(spark, layout)
    except quality.QualityGateError:
        ingest_feeds(spark, layout, SECOND_RUN)
    return comparable(read_raw(spark, layout.raw("telemetry"), TELEMETRY)).drop("ingestion_date")


@query
def master_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extract of whole records, and one with records cut off: these are set aside."""
    layout = Layout(new_folder(spark, "masters"))
    vehicles = inputs.vehicles(spark, sf_dir)
    land_masters(layout, {"vehicles": vehicles}, FIRST_DAY)
    poor = vehicles.where(F.col("capacity_kg") < 5000)
    cut = poor.select(F.substring(F.to_json(F.struct(*vehicles.columns)), 1, 30).alias("value"))
    cut.write.text(f"{layout.bronze('vehicles')}/vehicles_20240102")
    build_master(spark, layout, VEHICLES, SECOND_RUN)
    return read_current(spark, layout.quarantine("vehicles"))


@query
def history_after_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cold orders after a backup, corrections and another backup: each order once, on the day
    of its newest version."""
    layout = _lake(spark, sf_dir, "history")
    run_backup(spark, layout, FIRST_DAY)
    _load_feeds(spark, sf_dir, layout, 1)
    run_backup(spark, layout, SECOND_DAY)
    return snapshots.read_history(spark, layout.history("orders")).select("order_id", "ingestion_day")


@query
def models_as_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over the views of staging and gold."""
    register_views(spark, _lake(spark, sf_dir, "views"))
    return spark.sql(
        """
        SELECT vehicle_id, capacity_kg, count(*) AS n
        FROM stg_telemetry JOIN dim_vehicles USING (vehicle_id) GROUP BY vehicle_id, capacity_kg
        """
    )
