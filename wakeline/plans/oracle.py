"""DuckDB oracle SQL for every registered query (same columns as ``wakeline.plans.queries``)."""

from __future__ import annotations

from wakeline.plans.oracle_views import (
    BASELINE, CLASSIFIED, CLASSIFIED_DEVICE, LATE, ON_TIME, RAW_EVENTS, SENSOR, SPEED_W1, SPEED_W2,
    with_ctes,
)

from wakeline.plans.oracle_metrics import ORACLE_METRICS  # noqa: E402

LOGS = r"""
svc AS (
  SELECT *, ['stream_job', 'archive_sink', 'table_sink', 'live_feed', 'producer'][user_id % 5 + 1] AS service,
         strftime(ts, '%Y-%m-%d %H:%M:%S') || ' [' || CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END || '] '
           || ['stream_job', 'archive_sink', 'table_sink', 'live_feed', 'producer'][user_id % 5 + 1]
           || ' - event ' || CAST(event_id AS VARCHAR) || ' ' || event_type || ' props=' || props AS line
  FROM events
),
all_logs AS (
  SELECT '/logs/' || service || '/' || service || '.log' AS source,
         regexp_extract('/logs/' || service || '/' || service || '.log', '^/logs/([^/]+)/.*$', 1) AS service_name, line AS value
  FROM svc WHERE event_id % 2 = 0
  UNION ALL
  SELECT '/' || service, regexp_extract('/' || service, '^/(.*)$', 1), line FROM svc WHERE event_id % 2 = 1
),
parsed_logs AS (
  SELECT source, service_name,
         regexp_extract(value, '^(\S+ \S+) \[(\w+)\] (\S+) - (.*)$', 1) AS ts_text,
         regexp_extract(value, '^(\S+ \S+) \[(\w+)\] (\S+) - (.*)$', 2) AS level,
         regexp_extract(value, '^(\S+ \S+) \[(\w+)\] (\S+) - (.*)$', 3) AS logger,
         regexp_extract(value, '^(\S+ \S+) \[(\w+)\] (\S+) - (.*)$', 4) AS message
  FROM all_logs
)"""

_BASE = (SENSOR, CLASSIFIED, ON_TIME, LATE)
_XY = "seq, id, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y, timestamp"

PARSED = """
parsed AS (
  SELECT seq, value,
         CASE WHEN NOT json_valid(value) OR json_type(value) <> 'OBJECT' THEN 'malformed'
              WHEN json_extract(value, '$.id') IS NULL OR json_extract(value, '$.x') IS NULL
                OR json_extract(value, '$.y') IS NULL OR json_extract(value, '$.timestamp') IS NULL
                THEN 'missing_field'
         END AS reason
  FROM raw_events
)"""

ENRICHED = """
enriched AS (
  SELECT seq, id, x, y, timestamp, CAST(inst_speed AS FLOAT) AS inst_speed,
         CAST(1704067240e0 - timestamp AS FLOAT) AS time_taken FROM speed_w2
)"""

W2E = _BASE + (SPEED_W2, ENRICHED)

LATEST = """
latest AS (
  SELECT id, CAST(arg_max(y, seq) AS DOUBLE) AS lat, CAST(arg_max(x, seq) AS DOUBLE) AS lon,
         CAST(arg_max(inst_speed, seq) AS DOUBLE) AS inst_speed
  FROM enriched WHERE inst_speed IS NOT NULL GROUP BY id
)"""

_BATCHES = """
SELECT batch_no, count(*) AS n, min(seq) AS first_seq, max(seq) AS last_seq
FROM (SELECT seq, (row_number() OVER (ORDER BY seq) - 1) // {n} AS batch_no FROM {src})
GROUP BY batch_no"""

ORACLE: dict[str, str] = {
    "parse_events": with_ctes(RAW_EVENTS, PARSED) + """
SELECT seq, CAST(json_extract(value, '$.id') AS INTEGER) AS id,
       CAST(CAST(CAST(json_extract(value, '$.x') AS DOUBLE) AS FLOAT) AS DOUBLE) AS x,
       CAST(CAST(CAST(json_extract(value, '$.y') AS DOUBLE) AS FLOAT) AS DOUBLE) AS y,
       CAST(json_extract(value, '$.timestamp') AS DOUBLE) AS timestamp
FROM parsed WHERE reason IS NULL""",
    "quarantine_events": with_ctes(RAW_EVENTS, PARSED) + "SELECT seq, reason FROM parsed WHERE reason IS NOT NULL",
    "on_time_events": with_ctes(*_BASE) + f"SELECT {_XY} FROM on_time",
    "late_events": with_ctes(*_BASE) + f"SELECT {_XY} FROM late",
    "multi_partition_lateness": with_ctes(SENSOR, """
placed AS (SELECT *, id % 3 AS part, row_number() OVER (PARTITION BY id % 3 ORDER BY seq) - 1 AS off FROM sensor)""", """
ordered AS (SELECT part, off, off * 3 + part AS seq, id, timestamp FROM placed)""", CLASSIFIED.replace("FROM sensor", "FROM ordered"))
    + """
SELECT part AS "partition", off AS "offset", seq, id, timestamp, is_late FROM classified""",
    "clock_order_lateness": with_ctes(SENSOR, """
spread AS (SELECT (seq // 1000) * 1099511627776 + (seq % 1000) * 1009 + 1152921504606846976 AS seq, id, timestamp FROM sensor)""",
        CLASSIFIED.replace("FROM sensor", "FROM spread")) + """
SELECT seq, id, timestamp, is_late, (row_number() OVER (ORDER BY seq) - 1) // 200 AS batch_no FROM classified""",
    "lateness_by_device_scope": with_ctes(SENSOR, CLASSIFIED_DEVICE) + f"SELECT {_XY}, is_late FROM classified_device",
    "inst_speed": with_ctes(*_BASE, BASELINE, SPEED_W1)
    + "SELECT seq, id, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y, timestamp, baseline_seq, dt, inst_speed FROM speed_w1",
    "inst_speed_stateful": with_ctes(*_BASE, SPEED_W2)
    + "SELECT seq, id, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y, timestamp, baseline_seq, dt, inst_speed FROM speed_w2",
    "speed_suppressed": with_ctes(*_BASE, BASELINE) + """
SELECT seq, id, CASE WHEN b.seq = seq THEN 'first_in_horizon' ELSE 'gap_below_min' END AS reason
FROM based WHERE b.seq = seq OR timestamp - b.t < 1e0""",
    "time_taken": with_ctes(*W2E) + "SELECT seq, id, CAST(time_taken AS DOUBLE) AS time_taken FROM enriched",
    "on_time_by_device": with_ctes(*_BASE) + "SELECT id, count(*) AS n FROM on_time GROUP BY id",
    "on_time_total": with_ctes(*_BASE) + "SELECT count(*) AS n FROM on_time",
    "late_by_device": with_ctes(*_BASE) + "SELECT id, count(*) AS n FROM late GROUP BY id",
    "late_total": with_ctes(*_BASE) + "SELECT count(*) AS n FROM late",
    "time_counter_ms": with_ctes(*W2E)
    + "SELECT round(sum(CAST(time_taken AS DOUBLE) * 1000e0), 2) AS ms FROM enriched",
    "device_counters_long": with_ctes(*W2E) + """
SELECT 'on_time_device_' || CAST(id AS VARCHAR) AS metric, round(CAST(count(*) AS DOUBLE), 2) AS value FROM on_time GROUP BY id
UNION ALL
SELECT 'late_device_' || CAST(id AS VARCHAR), round(CAST(count(*) AS DOUBLE), 2) FROM late GROUP BY id
UNION ALL SELECT 'total_on_time_events', round(CAST(count(*) AS DOUBLE), 2) FROM on_time
UNION ALL SELECT 'total_late_events', round(CAST(count(*) AS DOUBLE), 2) FROM late
UNION ALL SELECT 'time_counter_ms', round(coalesce(sum(CAST(time_taken AS DOUBLE) * 1000e0), 0e0), 2) FROM enriched""",
    "raw_json": with_ctes(SENSOR) + f"SELECT {_XY} FROM sensor",
    "enriched_json": with_ctes(*W2E)
    + f"SELECT {_XY}, CAST(inst_speed AS DOUBLE) AS inst_speed, CAST(time_taken AS DOUBLE) AS time_taken FROM enriched",
    "archive_batches": with_ctes(RAW_EVENTS)
    + _BATCHES.format(n=200, src="(SELECT seq FROM raw_events WHERE json_valid(value))"),
    "archive_replay": with_ctes(RAW_EVENTS) + """
SELECT CAST(json_extract(value, '$.id') AS BIGINT) AS id, CAST(json_extract(value, '$.x') AS DOUBLE) AS x,
       CAST(json_extract(value, '$.y') AS DOUBLE) AS y, CAST(json_extract(value, '$.timestamp') AS DOUBLE) AS timestamp
FROM raw_events WHERE json_valid(value)""",
    "readings_batches": with_ctes(*W2E) + _BATCHES.format(n=20, src="enriched"),
    "readings_append": with_ctes(*W2E) + """
SELECT row_number() OVER (ORDER BY seq) AS reading_id, id AS device_id, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y,
       CAST(round_even(timestamp * 1000000e0, 0) AS BIGINT) AS ts_us,
       CAST(inst_speed AS DOUBLE) AS inst_speed, CAST(time_taken AS DOUBLE) AS time_taken
FROM enriched""",
    "rejected_readings": with_ctes(*W2E) + """
SELECT o.seq, o.id, 'inst_speed,time_taken' AS reason FROM on_time o ANTI JOIN enriched e ON e.seq = o.seq""",
    "latest_per_device": with_ctes(*W2E, LATEST) + "SELECT * FROM latest",
    "speed_board": with_ctes(*W2E, LATEST) + """
SELECT s.id, coalesce(CAST(floor(l.inst_speed) AS BIGINT) + (CAST((l.inst_speed - floor(l.inst_speed)) * 144115188075855872e0 AS BIGINT) * 20 + 144115188075855872) // 288230376151711744 // 10 || '.'
         || (CAST((l.inst_speed - floor(l.inst_speed)) * 144115188075855872e0 AS BIGINT) * 20 + 144115188075855872) // 288230376151711744 % 10, '0.0') AS speed_text,
       coalesce(l.lat, 52.448922e0 - CAST(s.id - 1 AS DOUBLE) / 1000e0) AS lat, coalesce(l.lon, 21.031619e0) AS lon
FROM (SELECT unnest([1, 2, 3, 4, 5, 6]) AS id) s LEFT JOIN latest l ON l.id = s.id""",
    **ORACLE_METRICS,
    "parse_logs": with_ctes(LOGS) + "SELECT ts_text, level, logger, message, service_name FROM parsed_logs",
    "service_labels": with_ctes(LOGS) + "SELECT DISTINCT source, service_name FROM parsed_logs",
    "error_logs": with_ctes(LOGS) + """
SELECT ts_text, level, logger, message, service_name FROM parsed_logs
WHERE length(service_name) > 0 AND lower(level) = 'error' ORDER BY ts_text DESC""",
}

# Fed in slices, the stream gives what the batch queries give.
ORACLE["stream_partition_lateness"] = ORACLE["multi_partition_lateness"]
ORACLE["stream_device_lateness"] = with_ctes(SENSOR, CLASSIFIED_DEVICE) + "SELECT seq, id, timestamp, is_late FROM classified_device"
ORACLE["stream_counters"] = with_ctes(*_BASE) + """
SELECT 'on_time_device_' || CAST(id AS VARCHAR) AS metric, count(*) AS value FROM on_time GROUP BY id
UNION ALL SELECT 'late_device_' || CAST(id AS VARCHAR), count(*) FROM late GROUP BY id
UNION ALL SELECT 'total_on_time_events', count(*) FROM on_time
UNION ALL SELECT 'total_late_events', count(*) FROM late"""
ORACLE["stream_alert_transitions"] = ORACLE["alert_transitions"]
