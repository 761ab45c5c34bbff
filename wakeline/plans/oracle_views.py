"""DuckDB forms of the fixture views (the same formulas as ``wakeline.sources.fixtures``).

Used only to build the oracle SQL strings; every string starts with these CTEs
over the pre-registered ``events`` view.
"""

SENSOR = """
sensor AS (
  SELECT event_id AS seq,
         CAST(user_id AS INTEGER) AS id,
         CAST(21.020602e0 + ((event_id * 37) % 22509) / 1000000e0 AS FLOAT) AS x,
         CAST(52.439085e0 + ((event_id * 91) % 17259) / 1000000e0 AS FLOAT) AS y,
         1704067200e0 + (epoch_us(ts) - 1704067200000000) / 64800000000e0
           - CASE WHEN event_id % 20 = 13 THEN 5e0 ELSE 0e0 END AS timestamp,
         1704067200e0 + (epoch_us(ts) - 1704067200000000) / 648000000e0 AS arrival,
         event_type, value
  FROM events
)"""

RAW_EVENTS = """
raw_events AS (
  SELECT event_id AS seq,
         CASE WHEN event_id % 97 = 0 THEN 'not json'
              WHEN event_id % 101 = 0 THEN CAST(json_object(
                   'id', user_id,
                   'x', 21.020602e0 + ((event_id * 37) % 22509) / 1000000e0,
                   'timestamp', 1704067200e0 + (epoch_us(ts) - 1704067200000000) / 64800000000e0
                                - CASE WHEN event_id % 20 = 13 THEN 5e0 ELSE 0e0 END) AS VARCHAR)
              ELSE CAST(json_object(
                   'id', user_id,
                   'x', 21.020602e0 + ((event_id * 37) % 22509) / 1000000e0,
                   'y', 52.439085e0 + ((event_id * 91) % 17259) / 1000000e0,
                   'timestamp', 1704067200e0 + (epoch_us(ts) - 1704067200000000) / 64800000000e0
                                - CASE WHEN event_id % 20 = 13 THEN 5e0 ELSE 0e0 END) AS VARCHAR)
         END AS value
  FROM events
)"""

# Global running-max lateness (W0) on the sensor view.
CLASSIFIED = """
classified AS (
  SELECT *,
         NOT (NOT isnan(timestamp) AND timestamp > greatest(0e0, coalesce(max(CASE WHEN isnan(timestamp) THEN NULL ELSE timestamp END)
               OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0))) AS is_late
  FROM sensor
)"""

CLASSIFIED_DEVICE = """
classified_device AS (
  SELECT *,
         NOT (NOT isnan(timestamp) AND timestamp > greatest(0e0, coalesce(max(CASE WHEN isnan(timestamp) THEN NULL ELSE timestamp END)
               OVER (PARTITION BY id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0))) AS is_late
  FROM sensor
)"""

ON_TIME = """
on_time AS (SELECT seq, id, x, y, timestamp, arrival FROM classified WHERE NOT is_late)"""

LATE = """
late AS (SELECT seq, id, x, y, timestamp, arrival FROM classified WHERE is_late)"""

# Oldest event of the device within 5 s (range frame), emit when dt >= 1.
BASELINE = """
based AS (
  SELECT *, min({'t': timestamp, 'seq': seq, 'x': x, 'y': y}) OVER (
           PARTITION BY id ORDER BY timestamp RANGE BETWEEN 5e0 PRECEDING AND CURRENT ROW) AS b
  FROM on_time
)"""

SPEED_W1 = """
speed_w1 AS (
  SELECT seq, id, x, y, timestamp, b.seq AS baseline_seq, timestamp - b.t AS dt,
         CAST(CAST(sqrt((CAST(x AS DOUBLE) - CAST(b.x AS DOUBLE)) * (CAST(x AS DOUBLE) - CAST(b.x AS DOUBLE))
                       + (CAST(y AS DOUBLE) - CAST(b.y AS DOUBLE)) * (CAST(y AS DOUBLE) - CAST(b.y AS DOUBLE)))
                  * 111320e0 / (timestamp - b.t) AS FLOAT) AS DOUBLE) AS inst_speed
  FROM based
  WHERE b.seq <> seq AND timestamp - b.t >= 1e0
)"""

# The coded fold as a recursive CTE over each device's on-time events.
SPEED_W2 = """
ev AS (
  SELECT id, seq, x, y, timestamp AS t, row_number() OVER (PARTITION BY id ORDER BY seq) AS n FROM on_time
),
fold AS (
  SELECT id, n, seq, [{'seq': seq, 'x': CAST(x AS DOUBLE), 'y': CAST(y AS DOUBLE), 't': t}] AS st,
         NULL::STRUCT(seq BIGINT, x DOUBLE, y DOUBLE, t DOUBLE) AS b,
         {'seq': seq, 'x': CAST(x AS DOUBLE), 'y': CAST(y AS DOUBLE), 't': t} AS cur
  FROM ev WHERE n = 1
  UNION ALL
  SELECT id, n, seq,
         CASE WHEN len(q) = 0 THEN [cur] ELSE list_append(q, cur) END AS st,
         CASE WHEN len(q) > 0 THEN q[len(q)] END AS b,
         cur
  FROM (
    SELECT e.id, e.n, e.seq, c.cur,
           list_reverse(f.st)[1 : coalesce(list_position(
               list_transform(list_reverse(f.st), lambda s: c.cur.t - s.t > 5e0), true) - 1, len(f.st))] AS q
    FROM fold f
    JOIN ev e ON e.id = f.id AND e.n = f.n + 1
    CROSS JOIN LATERAL (SELECT {'seq': e.seq, 'x': CAST(e.x AS DOUBLE), 'y': CAST(e.y AS DOUBLE), 't': e.t} AS cur) c
  )
),
speed_w2 AS (
  SELECT o.seq, o.id, o.x, o.y, o.timestamp, f.b.seq AS baseline_seq, f.cur.t - f.b.t AS dt,
         CAST(CAST(sqrt((f.cur.x - f.b.x) * (f.cur.x - f.b.x) + (f.cur.y - f.b.y) * (f.cur.y - f.b.y))
                  * 111320e0 / (f.cur.t - f.b.t) AS FLOAT) AS DOUBLE) AS inst_speed
  FROM fold f JOIN on_time o ON o.seq = f.seq
  WHERE f.b IS NOT NULL AND f.cur.t - f.b.t >= 1e0
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",".join(ctes) + "\n"
