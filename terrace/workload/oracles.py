"""For each query, plain SQL over the whole tables that must give the same rows."""

from __future__ import annotations

_FLEET_EVENTS = """
    SELECT e.*, 'customer#' || lpad(CAST(e.user_id AS VARCHAR), 9, '0') AS vehicle FROM events e
"""


def _mean(c: str) -> str:
    """The mean of doubles, summed as whole multiples of 2^-20 and 2^-72."""
    high = f"trunc({c} * 1048576)"
    low = f"trunc(({c} * 1048576 - {high}) * 4503599627370496)"
    return (
        f"(CAST(sum(CAST({high} AS HUGEINT)) AS DOUBLE) / 1048576 + "
        f"CAST(sum(CAST({low} AS HUGEINT)) AS DOUBLE) / 4722366482869645213696) / count({c})"
    )


def _fleet(customers: str, status: str | None = None) -> str:
    kept = "" if status is None else f"WHERE trim(upper(event_type)) = trim(upper('{status}'))"
    return f"""
        WITH readings AS (
            SELECT trim(upper(vehicle)) AS vehicle_id, ts, value AS reading
            FROM ({_FLEET_EVENTS}) {kept}
        ), fleet AS (
            SELECT trim(upper(c_name)) AS vehicle_id, c_acctbal AS capacity_kg FROM ({customers})
        )
        SELECT vehicle_id, capacity_kg, count(ts) AS total_telemetry_events,
               round({_mean("reading")}, 2) AS avg_cargo_temperature
        FROM readings JOIN fleet USING (vehicle_id)
        GROUP BY ALL
        ORDER BY total_telemetry_events DESC, vehicle_id, capacity_kg
    """


_TELEMETRY = """
    SELECT 'EVT-' || l_orderkey || '-' || l_linenumber AS event_id,
           'V-' || l_suppkey AS vehicle_id,
           l_shipdate AS "timestamp",
           CAST(CAST(l_discount AS FLOAT) AS DOUBLE) AS latitude,
           CAST(CAST(l_tax AS FLOAT) AS DOUBLE) AS longitude,
           l_returnflag AS delivery_status,
           CAST(CAST(l_quantity AS FLOAT) AS DOUBLE) AS cargo_temp_c,
           CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE) AS speed_kmh
    FROM lineitem
"""

_TELEMETRY_TIES = """
    vehicle_id DESC, "timestamp" DESC, latitude DESC, longitude DESC,
    delivery_status DESC, cargo_temp_c DESC, speed_kmh DESC
"""

_ORDERS = """
    SELECT 'ORD-' || o_custkey AS order_id,
           o_orderpriority AS product_name,
           CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) AS weight_kg,
           CAST(CAST(o_orderkey AS FLOAT) AS DOUBLE) AS destination_lat,
           CAST(CAST(o_custkey AS FLOAT) AS DOUBLE) AS destination_lon,
           o_orderstatus AS status,
           o_orderdate AS created_at
    FROM orders
"""

_ORDERS_TIES = """
    product_name DESC, weight_kg DESC, destination_lat DESC, destination_lon DESC,
    status DESC, created_at DESC
"""

_VEHICLES = """
    SELECT 'V-' || s_suppkey AS vehicle_id,
           s_name AS vehicle_type,
           CAST(trunc(s_acctbal) AS INTEGER) AS capacity_kg,
           'ACTIVE' AS status
    FROM supplier
"""

_DRIVERS = """
    SELECT 'D-' || c_custkey AS driver_id,
           c_name AS name,
           c_mktsegment AS license_type,
           CASE WHEN c_acctbal > 0 THEN 'AVAILABLE' ELSE 'OFF_DUTY' END AS status
    FROM customer
"""

_BAND = """
    CASE WHEN {c} > 8.0 THEN 'CRITICAL_HIGH' WHEN {c} < 2.0 THEN 'CRITICAL_LOW' ELSE 'NORMAL' END
"""

_LATEST_LINES = """
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                     l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
                     l_linestatus DESC) AS rn
        FROM lineitem)
    WHERE rn = 1
"""

_STG_ORDERS = f"""
    SELECT order_id, product_name, weight_kg, destination_lat, destination_lon,
           status AS order_status, created_at AS order_created_at, created_at AS ingestion_date
    FROM (SELECT *, row_number() OVER (
              PARTITION BY order_id ORDER BY created_at DESC, {_ORDERS_TIES}) AS rn
          FROM ({_ORDERS}))
    WHERE rn = 1
"""


def _stg_telemetry(known: str) -> str:
    return f"""
        SELECT event_id, vehicle_id, "timestamp" AS event_timestamp, latitude, longitude,
               cargo_temp_c, speed_kmh, delivery_status, "timestamp" AS ingestion_date
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY event_id ORDER BY "timestamp" DESC, {_TELEMETRY_TIES}) AS rn
              FROM ({_TELEMETRY}))
        WHERE rn = 1 AND vehicle_id IN ({known})
    """


_RUN_TIME = """
    CASE WHEN load = 1 THEN TIMESTAMP '2024-01-01 12:00:00'
         ELSE TIMESTAMP '2024-01-02 12:00:00' END
"""


def _known(minimum: int) -> str:
    return f"SELECT 'V-' || s_suppkey FROM supplier WHERE s_acctbal > {minimum}"


_FACT_TELEMETRY = f"""
    WITH feed AS (
        SELECT *, CASE WHEN "timestamp" < TIMESTAMP '1998-01-01' THEN 1 ELSE 2 END AS load
        FROM ({_TELEMETRY})
    ), ranked AS (
        SELECT *,
               row_number() OVER (
                   PARTITION BY event_id ORDER BY load DESC, {_TELEMETRY_TIES}) AS rn_all,
               row_number() OVER (
                   PARTITION BY event_id, load ORDER BY {_TELEMETRY_TIES}) AS rn_load
        FROM feed
    ), latest AS (
        SELECT * FROM ranked WHERE rn_all = 1
    ), merged AS (
        SELECT * FROM latest WHERE vehicle_id IN ({_known(-500)})
        UNION ALL
        SELECT * FROM ranked
        WHERE load = 1 AND rn_load = 1 AND vehicle_id IN ({_known(0)})
          AND event_id IN (SELECT event_id FROM latest WHERE vehicle_id NOT IN ({_known(-500)}))
    )
    SELECT event_id, vehicle_id, "timestamp" AS event_timestamp, latitude, longitude,
           cargo_temp_c, speed_kmh, {_BAND.format(c="cargo_temp_c")} AS temperature_alert_status,
           delivery_status, {_RUN_TIME} AS ingestion_date
    FROM merged
"""

_FACT_ORDERS = f"""
    SELECT order_id, product_name, weight_kg, destination_lat, destination_lon,
           status AS order_status, created_at AS order_created_at, {_RUN_TIME} AS ingestion_date
    FROM (SELECT *, row_number() OVER (
              PARTITION BY order_id ORDER BY load DESC, {_ORDERS_TIES}) AS rn
          FROM (SELECT *, CASE WHEN created_at < TIMESTAMP '1998-01-01' THEN 1 ELSE 2 END AS load
                FROM ({_ORDERS})))
    WHERE rn = 1
"""

_GOLD_TESTS = f"""
    WITH dim AS (
        SELECT * FROM ({_VEHICLES}) WHERE capacity_kg > 0
    ), tests AS (
        SELECT 'dim_vehicles' AS "table", 'vehicle_id' AS "column", 'unique' AS test,
               (SELECT count(*) FROM (SELECT vehicle_id FROM dim GROUP BY 1 HAVING count(*) > 1))
                   AS failures
        UNION ALL SELECT 'dim_vehicles', 'vehicle_id', 'not_null',
               (SELECT count(*) FROM dim WHERE vehicle_id IS NULL)
        UNION ALL SELECT 'dim_vehicles', 'capacity_kg', 'not_null',
               (SELECT count(*) FROM dim WHERE capacity_kg IS NULL)
        UNION ALL SELECT 'dim_drivers', 'driver_id', 'unique',
               (SELECT count(*) FROM (SELECT c_custkey FROM customer WHERE c_acctbal > 0
                                      GROUP BY 1 HAVING count(*) > 1))
        UNION ALL SELECT 'dim_drivers', 'driver_id', 'not_null',
               (SELECT count(*) FROM customer WHERE c_acctbal > 0 AND c_custkey IS NULL)
        UNION ALL SELECT 'fact_telemetry', 'event_id', 'unique',
               (SELECT count(*) FROM (SELECT event_id FROM ({_TELEMETRY})
                                      GROUP BY 1 HAVING count(*) > 1))
        UNION ALL SELECT 'fact_telemetry', 'event_id', 'not_null',
               (SELECT count(*) FROM ({_TELEMETRY}) WHERE event_id IS NULL)
        UNION ALL SELECT 'fact_telemetry', 'vehicle_id', 'not_null',
               (SELECT count(*) FROM ({_TELEMETRY}) WHERE vehicle_id IS NULL)
        UNION ALL SELECT 'fact_telemetry', 'vehicle_id', 'relationships',
               (SELECT count(*) FROM ({_TELEMETRY})
                WHERE vehicle_id NOT IN (SELECT vehicle_id FROM dim))
        UNION ALL SELECT 'fact_orders', 'order_id', 'unique',
               (SELECT count(*) FROM (SELECT order_id FROM ({_ORDERS})
                                      GROUP BY 1 HAVING count(*) > 1))
        UNION ALL SELECT 'fact_orders', 'order_id', 'not_null',
               (SELECT count(*) FROM ({_ORDERS}) WHERE order_id IS NULL)
        UNION ALL SELECT 'fact_orders', 'destination_lat', 'not_null',
               (SELECT count(*) FROM ({_ORDERS}) WHERE status = 'P')
    )
    SELECT "table", "column", test, CAST(failures AS BIGINT) AS failures,
           failures = 0 AS passed
    FROM tests
"""

_EXPECTATIONS = """
    SELECT 'not_null' AS "check", 'user_id' AS "column", CAST(count(*) AS BIGINT) AS evaluated,
           CAST(count(*) FILTER (event_type = 'view') AS BIGINT) AS unexpected,
           count(*) FILTER (event_type = 'view') = 0 AS passed
    FROM events
    UNION ALL
    SELECT 'not_null', 'ts', count(*), count(*) FILTER (ts IS NULL),
           count(*) FILTER (ts IS NULL) = 0
    FROM events
    UNION ALL
    SELECT 'between', 'value', count(*), count(*) FILTER (NOT (value BETWEEN -50.0 AND 100.0)),
           count(*) FILTER (NOT (value BETWEEN -50.0 AND 100.0)) = 0
    FROM events
"""

_GATE_REPORT = """
    WITH counted AS (
        SELECT count(*) AS n,
               count(*) FILTER (l_returnflag = 'R') AS no_latitude,
               count(*) FILTER (l_returnflag = 'A') AS no_longitude,
               count(*) FILTER (l_returnflag = 'N' AND l_quantity * 4 > 100) AS too_hot
        FROM lineitem
    )
    SELECT 'not_null' AS "check", 'latitude' AS "column", CAST(n AS BIGINT) AS evaluated,
           CAST(no_latitude AS BIGINT) AS unexpected, no_latitude = 0 AS passed
    FROM counted
    UNION ALL
    SELECT 'not_null', 'longitude', n, no_longitude, no_longitude = 0 FROM counted
    UNION ALL
    SELECT 'between', 'cargo_temp_c', n, too_hot, too_hot = 0 FROM counted
    UNION ALL
    SELECT 'null', 'unreadable_cargo_temp_c', n, 0, true FROM counted
"""

_BACKUP = f"""
    SELECT 'fact_orders' AS table_name, DATE '1998-01-01' AS day, CAST(count(*) AS BIGINT) AS n
    FROM ({_STG_ORDERS}) WHERE CAST(ingestion_date AS DATE) = DATE '1998-01-01' HAVING count(*) > 0
    UNION ALL
    SELECT 'fact_telemetry', DATE '1998-01-01', count(*)
    FROM ({_stg_telemetry("SELECT vehicle_id FROM (" + _VEHICLES + ")")})
    WHERE CAST(ingestion_date AS DATE) = DATE '1998-01-01' HAVING count(*) > 0
    UNION ALL
    SELECT 'dim_vehicles', DATE '1998-01-01', count(*) FROM supplier
    UNION ALL
    SELECT 'dim_drivers', DATE '1998-01-01', count(*) FROM customer WHERE c_acctbal > 0
"""

_KEYED_UPSERT = """
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, l_orderkey || '-' || l_linenumber AS line_id, row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate >= TIMESTAMP '1998-01-01' DESC,
                     l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                     l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
                     l_linestatus DESC) AS rn
        FROM lineitem)
    WHERE rn = 1
"""

ORACLES: dict[str, str] = {
    "fleet_metrics": _fleet("SELECT * FROM customer"),
    "fleet_metrics_status": _fleet("SELECT * FROM customer", status=" Error "),
    "fleet_metrics_all_snapshots": _fleet(
        "SELECT * FROM customer UNION ALL SELECT * FROM customer"
    ),
    "fleet_metrics_cold": _fleet("SELECT * FROM customer", status="view"),
    "temperature_alerts": f"""
        SELECT user_id AS vehicle_id, CAST(count(*) AS BIGINT) AS total_alerts,
               round({_mean("value")}, 2) AS alert_avg_temperature
        FROM events WHERE value > 12.0 GROUP BY user_id ORDER BY total_alerts DESC, vehicle_id
    """,
    "alert_records": """
        SELECT to_json({'vehicle_id': user_id, 'total_alerts': count(*)})::VARCHAR AS record
        FROM events WHERE value > 100.0 GROUP BY user_id
    """,
    "temperature_band": f"""
        SELECT event_id, value, {_BAND.format(c="value")} AS temperature_alert_status FROM events
    """,
    "band_counts": f"""
        SELECT {_BAND.format(c="value")} AS temperature_alert_status, CAST(count(*) AS BIGINT) AS n
        FROM events GROUP BY 1
    """,
    "dim_filter_rename": """
        SELECT o_orderkey AS order_id, o_orderstatus AS order_status,
               o_orderdate AS order_created_at
        FROM orders WHERE o_orderstatus = 'F'
    """,
    "key_normalisation": """
        SELECT upper(event_type) AS status_key, CAST(count(*) AS BIGINT) AS n,
               round(avg(value), 2) AS avg_value
        FROM events GROUP BY 1
    """,
    "type_coercion": """
        SELECT l_orderkey, l_linenumber,
               CASE WHEN l_returnflag <> 'R'
                    THEN CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE) END AS as_float,
               CASE WHEN l_returnflag <> 'R'
                    THEN CAST(trunc(l_extendedprice) AS INTEGER) END AS as_int,
               CAST(CAST(l_discount AS FLOAT) AS DOUBLE) AS discount_float
        FROM lineitem
    """,
    "timestamp_coercion": """
        SELECT o_orderkey,
               CASE WHEN o_orderstatus <> 'P'
                    THEN o_orderdate - INTERVAL 2 HOUR + INTERVAL 250 MILLISECOND END AS created_at
        FROM orders
    """,
    "latest_line_version": _LATEST_LINES,
    "latest_then_ref": f"""
        SELECT * FROM ({_LATEST_LINES})
        WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)
    """,
    "distinct_orders_by_priority": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (
                PARTITION BY priority
                ORDER BY o_orderkey DESC, o_custkey DESC, o_orderstatus DESC, o_totalprice DESC,
                         o_orderdate DESC, o_orderpriority DESC) AS rn
            FROM (SELECT *, nullif(o_orderpriority, '5-LOW') AS priority FROM orders))
        WHERE rn = 1
    """,
    "referential_filter": """
        SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem
        WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)
    """,
    "ref_orphans": """
        SELECT l_suppkey, CAST(count(*) AS BIGINT) AS orphans FROM lineitem
        WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)
        GROUP BY l_suppkey
    """,
    "unique_violations": """
        SELECT l_orderkey, CAST(count(*) AS BIGINT) AS n FROM lineitem
        GROUP BY l_orderkey HAVING count(*) > 1
    """,
    "expectations": _EXPECTATIONS,
    "telemetry_gate_report": _GATE_REPORT,
    "gold_tests": _GOLD_TESTS,
    "clean_vehicles_newest_day": """
        SELECT 'V-' || s_suppkey AS vehicle_id, s_name AS vehicle_type,
               CAST(trunc(CASE WHEN s_acctbal > 0 THEN s_acctbal + 1000 ELSE s_acctbal END)
                    AS INTEGER) AS capacity_kg,
               'ACTIVE' AS status
        FROM supplier
    """,
    "clean_drivers_batch": _DRIVERS,
    "clean_telemetry_batch": f"""
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY {_TELEMETRY_TIES}) AS rn
            FROM ({_TELEMETRY}) WHERE delivery_status <> 'R')
        WHERE rn = 1
    """,
    "clean_orders_batch": f"""
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {_ORDERS_TIES}) AS rn
            FROM ({_ORDERS}))
        WHERE rn = 1
    """,
    "stg_vehicles": f"""
        SELECT vehicle_id, vehicle_type, capacity_kg, status AS vehicle_status FROM ({_VEHICLES})
    """,
    "stg_drivers": f"""
        SELECT driver_id, name AS driver_name, license_type, status AS driver_status
        FROM ({_DRIVERS})
    """,
    "stg_telemetry": _stg_telemetry(_known(0)),
    "stg_orders": _STG_ORDERS,
    "dim_vehicles": f"""
        SELECT vehicle_id, vehicle_type, capacity_kg, status AS vehicle_status FROM ({_VEHICLES})
    """,
    "dim_drivers": f"""
        SELECT driver_id, name AS driver_name, license_type, status AS driver_status
        FROM ({_DRIVERS}) WHERE status = 'AVAILABLE'
    """,
    "fact_telemetry": _FACT_TELEMETRY,
    "fact_orders": _FACT_ORDERS,
    "watermark_value": """
        SELECT 'filled' AS target, max(o_orderdate) AS watermark FROM orders
        WHERE o_orderdate < TIMESTAMP '1998-01-01'
        UNION ALL
        SELECT 'empty', TIMESTAMP '1900-01-01 00:00:00'
    """,
    "watermark_changes": """
        SELECT * FROM orders WHERE o_orderdate > (
            SELECT coalesce(max(o_orderdate), TIMESTAMP '1900-01-01') FROM orders
            WHERE o_orderdate < TIMESTAMP '1998-01-01')
    """,
    "watermark_first_run": "SELECT * FROM orders",
    "keyed_upsert": _KEYED_UPSERT,
    "raw_append": _ORDERS,
    "d1_increment": """
        SELECT * FROM events
        WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16'
    """,
    "partitioned_export": """
        SELECT * REPLACE (CASE WHEN o_orderstatus = 'F' THEN -o_totalprice ELSE o_totalprice END
                          AS o_totalprice)
        FROM orders
    """,
    "snapshot_asof": """
        SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, c_mktsegment,
               DATE '2024-01-01' AS snapshot_date
        FROM customer
    """,
    "backup": _BACKUP,
    "json_roundtrip": "SELECT * FROM orders",
    "json_arrays_multiline": "SELECT * FROM orders",
    "stream_ingest": f"""
        SELECT *, CASE WHEN "timestamp" < TIMESTAMP '1998-01-01'
                       THEN TIMESTAMP '2024-01-01 12:00:00'
                       ELSE TIMESTAMP '2024-01-02 12:00:00' END AS ingestion_date
        FROM ({_TELEMETRY})
    """,
    "stream_resend_suppression": """
        SELECT 'EVT-' || event_id AS event_id, 'V-' || user_id AS vehicle_id, ts AS "timestamp",
               event_type AS delivery_status,
               CAST(CAST(value AS FLOAT) AS DOUBLE) AS cargo_temp_c
        FROM events
    """,
    "gate_then_ingest": f"""
        SELECT * FROM ({_TELEMETRY}) WHERE "timestamp" < TIMESTAMP '1998-01-01'
    """,
    "master_quarantine": """
        SELECT substr('{"vehicle_id":"V-' || s_suppkey || '","vehicle_type":"' || s_name || '"', 1, 30) AS _corrupt_record,
               '20240102' AS _source_day
        FROM supplier WHERE s_acctbal < 5000
    """,
    "history_after_corrections": f"""
        SELECT order_id, CASE WHEN max(created_at) < TIMESTAMP '1998-01-01' THEN DATE '2024-01-01'
                              ELSE DATE '2024-01-02' END AS ingestion_day
        FROM ({_ORDERS}) GROUP BY order_id
    """,
    "models_as_views": f"""
        SELECT vehicle_id, capacity_kg, CAST(count(*) AS BIGINT) AS n
        FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY {_TELEMETRY_TIES}) AS rn
              FROM ({_TELEMETRY}) WHERE "timestamp" < TIMESTAMP '1998-01-01')
        JOIN ({_VEHICLES}) USING (vehicle_id)
        WHERE rn = 1
        GROUP BY ALL
    """,
}
