"""DuckDB oracle SQL for the metric, dashboard and alert queries.

Written as small SQL builders so each CTE mirrors one Spark operator with the
same arithmetic order.
"""

from __future__ import annotations

from wakeline.plans.oracle_views import CLASSIFIED, ON_TIME, SENSOR, SPEED_W2, with_ctes

EVK = """
evk AS (
  SELECT *, CAST(greatest(1, ceil((arrival - 1704067200e0) / 15e0)) AS INTEGER) AS k
  FROM (SELECT *, 1704067200e0 + (epoch_us(ts) - 1704067200000000) / 648000000e0 AS arrival FROM events)
),
kmax AS (SELECT max(k) AS kmax FROM evk)"""

ENRICHED_K = """
enriched_k AS (
  SELECT s.seq, s.arrival, CAST(greatest(1, ceil((s.arrival - 1704067200e0) / 15e0)) AS INTEGER) AS k,
         CAST(1704067240e0 - w.timestamp AS FLOAT) AS time_taken
  FROM speed_w2 w JOIN sensor s ON s.seq = w.seq
)"""

CLASSIFIED_K = """
classified_k AS (
  SELECT *, CAST(greatest(1, ceil((arrival - 1704067200e0) / 15e0)) AS INTEGER) AS k FROM classified
)"""


def counter(name: str, inc_sql: str, series: list[str]) -> str:
    """Dense cumulative counter ``name(series..., k, units)`` from bump rows ``(series..., k, inc)``."""
    s = ", ".join(series)
    return f"""
{name}_inc AS (SELECT {s}, k, sum(inc) AS inc FROM ({inc_sql}) GROUP BY ALL),
{name}_first AS (SELECT {s}, min(k) AS k0 FROM {name}_inc GROUP BY ALL),
{name}_dense AS (SELECT {s}, CAST(unnest(generate_series(k0, kmax)) AS INTEGER) AS k FROM {name}_first, kmax),
{name} AS (
  SELECT {s}, k, CAST(sum(coalesce(inc, 0)) OVER (PARTITION BY {s} ORDER BY k ROWS UNBOUNDED PRECEDING) AS BIGINT) AS units
  FROM {name}_dense LEFT JOIN {name}_inc USING ({s}, k)
)"""


def rate(name: str, src: str, series: list[str], scale: float = 1.0, window: float = 300.0,
         extrapolate: bool = True, step: float = 15.0, where: str = "TRUE") -> str:
    """``name(series..., k, value)``: the same rate rule as ``wakeline.operators.metrics.rate``."""
    s = ", ".join(series)
    m = int(round(window / step))
    w = f"(PARTITION BY {s} ORDER BY k RANGE BETWEEN {m} PRECEDING AND CURRENT ROW)"
    head = f"""
{name}_d AS (
  SELECT {s}, k, units,
         CASE WHEN lag(units) OVER (PARTITION BY {s} ORDER BY k) IS NULL THEN NULL
              WHEN units < lag(units) OVER (PARTITION BY {s} ORDER BY k) THEN units
              ELSE units - lag(units) OVER (PARTITION BY {s} ORDER BY k) END AS delta
  FROM {src} WHERE {where}
),
{name}_w AS (
  SELECT {s}, k, count(*) OVER {w} AS n, first_value(k) OVER {w} AS k0, first_value(units) OVER {w} AS fu,
         CAST(sum(delta) OVER {w} - coalesce(first_value(delta) OVER {w}, 0) AS BIGINT) AS incu
  FROM {name}_d
),
{name}_i AS (SELECT *, CAST(incu AS DOUBLE) / {float(scale)!r}e0 AS inc FROM {name}_w WHERE n >= 2)"""
    if not extrapolate:
        return head + f""",
{name} AS (SELECT {s}, k, inc / {float(window)!r}e0 AS value FROM {name}_i)"""
    return head + f""",
{name}_x AS (
  SELECT *, CAST(k - k0 AS DOUBLE) * {step!r}e0 AS sampled,
         CAST(fu AS DOUBLE) / {float(scale)!r}e0 AS first_v
  FROM {name}_i
),
{name}_y AS (
  SELECT *, sampled / CAST(n - 1 AS DOUBLE) AS avgd FROM {name}_x
),
{name}_z AS (
  SELECT *, CASE WHEN CAST(k0 - (k - {m}) AS DOUBLE) * {step!r}e0 >= avgd * 1.1e0 THEN avgd / 2e0
                 ELSE CAST(k0 - (k - {m}) AS DOUBLE) * {step!r}e0 END AS ts0,
            CASE WHEN inc > 0 AND first_v >= 0 THEN sampled * (first_v / inc) END AS tz
  FROM {name}_y
),
{name} AS (
  SELECT {s}, k,
         inc * ((sampled + (CASE WHEN tz IS NOT NULL AND tz < ts0 THEN tz ELSE ts0 END) + 0e0) / sampled / {float(window)!r}e0) AS value
  FROM {name}_z
)"""


PIPE = counter("pipe", """
  SELECT CASE WHEN is_late THEN 'late_device_' ELSE 'on_time_device_' END || CAST(id AS VARCHAR) AS metric,
         CAST(id AS VARCHAR) AS id, k, CAST(1 AS BIGINT) AS inc FROM classified_k
  UNION ALL
  SELECT CASE WHEN is_late THEN 'total_late_events' ELSE 'total_on_time_events' END, '', k, CAST(1 AS BIGINT) FROM classified_k
  UNION ALL
  SELECT 'time_counter_ms', '', k, CAST(round(CAST(time_taken AS DOUBLE) * 1000000e0) AS BIGINT) FROM enriched_k
""", ["metric", "id"])

PIPE_CTES = (SENSOR, CLASSIFIED, ON_TIME, SPEED_W2, EVK, ENRICHED_K, CLASSIFIED_K, PIPE)

DEVICE_ONLY = "(metric LIKE 'on_time_device_%' OR metric LIKE 'late_device_%')"

INSTANCE = "'node-' || CAST(user_id % 3 AS VARCHAR)"
CENTS = "CAST(round(value * 100e0) AS BIGINT)"
MODE = ("CASE event_type WHEN 'view' THEN 'idle' WHEN 'click' THEN 'user' WHEN 'purchase' THEN 'system' "
        "WHEN 'signup' THEN 'iowait' WHEN 'error' THEN 'irq' END")

CPU = counter("cpu", f"SELECT {INSTANCE} AS instance, CAST(user_id % 4 AS VARCHAR) AS cpu, {MODE} AS mode, k, "
                     f"{CENTS} AS inc FROM evk WHERE {MODE} IS NOT NULL", ["instance", "cpu", "mode"])


def net(direction: str) -> str:
    et = "click" if direction == "receive" else "purchase"
    return counter(f"net_{direction}", f"SELECT {INSTANCE} AS instance, 'eth0' AS device, k, {CENTS} * 10 AS inc "
                                       f"FROM evk WHERE event_type = '{et}'", ["instance", "device"])


def swap(direction: str) -> str:
    et = "error" if direction == "in" else "signup"
    return counter(f"swap_{direction}", f"SELECT {INSTANCE} AS instance, k, CAST(1 AS BIGINT) AS inc "
                                        f"FROM evk WHERE event_type = '{et}'", ["instance"])


MEMORY = f"""
mem_last AS (SELECT {INSTANCE} AS instance, k, arg_max({CENTS}, event_id) AS c FROM evk GROUP BY ALL),
mem_grid AS (SELECT instance, CAST(unnest(generate_series(1, kmax)) AS INTEGER) AS k FROM (SELECT DISTINCT instance FROM mem_last), kmax),
mem AS (
  SELECT instance, k, CAST(16000000000 AS DOUBLE) AS total,
         CAST(16000000000 - coalesce(last_value(c IGNORE NULLS) OVER (PARTITION BY instance ORDER BY k ROWS UNBOUNDED PRECEDING), 0) * 100000 AS DOUBLE) AS available
  FROM mem_grid LEFT JOIN mem_last USING (instance, k)
)"""

STAGES = """
stage_counts AS (
  SELECT 'source' AS stage, k, count(*) AS c FROM evk GROUP BY k
  UNION ALL SELECT 'sink', k, count(*) FROM enriched_k GROUP BY k
),
stage_grid AS (SELECT stage, CAST(unnest(generate_series(1, kmax)) AS INTEGER) AS k FROM (VALUES ('source'), ('sink')) t(stage), kmax),
stages AS (
  SELECT stage, k, CAST(coalesce(c, 0) AS DOUBLE) / 15e0 AS value FROM stage_grid LEFT JOIN stage_counts USING (stage, k)
),
out_in AS (
  SELECT o.k, o.value / (i.value + 1e-4) AS value
  FROM (SELECT k, sum(value) AS value FROM stages WHERE stage = 'sink' GROUP BY k) o
  JOIN (SELECT k, sum(value) AS value FROM stages WHERE stage = 'source' GROUP BY k) i ON i.k = o.k
)"""

BACKPRESSURE = f"""
bp_per AS (
  SELECT CASE WHEN user_id % 2 = 0 THEN 'source' ELSE 'sink' END AS task, k, sum({CENTS}) AS c, count(*) AS n
  FROM evk GROUP BY ALL
),
bp_grid AS (SELECT task, CAST(unnest(generate_series(1, kmax)) AS INTEGER) AS k FROM (SELECT DISTINCT task FROM bp_per), kmax),
bp AS (
  SELECT task, k, CASE WHEN n IS NULL THEN 0e0 ELSE CAST(c AS DOUBLE) / CAST(n * 10 AS DOUBLE) END AS value
  FROM bp_grid LEFT JOIN bp_per USING (task, k)
)"""

EVENTS_IN = (rate("r_on", "pipe", ["metric", "id"], where="metric = 'total_on_time_events'")
             + "," + rate("r_late", "pipe", ["metric", "id"], where="metric = 'total_late_events'") + """,
events_in AS (
  SELECT a.k, a.value + b.value AS value
  FROM (SELECT k, sum(value) AS value FROM r_on GROUP BY k) a
  JOIN (SELECT k, sum(value) AS value FROM r_late GROUP BY k) b ON a.k = b.k
)""")

LATE_RATIO = rate("r_dev", "(SELECT CASE WHEN metric LIKE 'late_%' THEN 'late' ELSE 'on_time' END AS kind, id, k, units "
                           f"FROM pipe WHERE {DEVICE_ONLY})", ["kind", "id"], window=60.0) + """,
late_ratio AS (
  SELECT a.k, a.id, a.value / b.value AS value
  FROM (SELECT k, id, sum(value) AS value FROM r_dev WHERE kind = 'late' GROUP BY ALL) a
  JOIN (SELECT k, id, sum(value + 1e-7) AS value FROM r_dev WHERE kind = 'on_time' GROUP BY ALL) b
    ON a.k = b.k AND a.id = b.id
)"""

AVG_PROC = (rate("r_ms", "pipe", ["metric", "id"], scale=1000.0, where="metric = 'time_counter_ms'")
            + "," + rate("r_on2", "pipe", ["metric", "id"], where="metric = 'total_on_time_events'") + """,
avg_proc AS (
  SELECT a.k, a.value / (b.value + 1e-5) AS value FROM r_ms a JOIN r_on2 b ON a.k = b.k
)""")

CPU_USAGE = CPU + "," + rate("r_idle", "cpu", ["instance", "cpu", "mode"], scale=100.0, where="mode = 'idle'") + """,
cpu_usage AS (
  SELECT k, instance, round(100e0 - avg(value) * 100e0, 6) AS value FROM r_idle GROUP BY ALL
)"""

NET_RX = net("receive") + "," + rate("r_rx", "net_receive", ["instance", "device"]) + """,
net_rx AS (SELECT k, round(sum(value), 6) AS value FROM r_rx GROUP BY k)"""
NET_TX = net("transmit") + "," + rate("r_tx", "net_transmit", ["instance", "device"]) + """,
net_tx AS (SELECT k, round(sum(value), 6) AS value FROM r_tx GROUP BY k)"""

MEM_USAGE = MEMORY + """,
memory_usage AS (SELECT k, instance, 100e0 * (1e0 - available / total) AS value FROM mem)"""


def alert_sql(values: str, grid: str, op: str, limit: float) -> str:
    """Gaps-and-islands states; ``values(series, k, value)``, ``grid(series, k)``."""
    cmp = {"gt": ">", "lt": "<"}[op]
    return f"""
SELECT k, series, value,
       CASE WHEN value IS NULL THEN 'nodata' WHEN NOT breach THEN 'ok'
            WHEN CAST(k - min(CASE WHEN breach THEN k END) OVER (PARTITION BY series, island ORDER BY k ROWS UNBOUNDED PRECEDING) AS DOUBLE) * 15e0 >= 60e0
              THEN 'firing' ELSE 'pending' END AS state
FROM (
  SELECT *, sum(CASE WHEN breach THEN 0 ELSE 1 END) OVER (PARTITION BY series ORDER BY k ROWS UNBOUNDED PRECEDING) AS island
  FROM (
    SELECT g.series, g.k, v.value, coalesce(v.value {cmp} {limit!r}e0, false) AS breach
    FROM ({grid}) g LEFT JOIN ({values}) v ON v.series = g.series AND v.k = g.k
  )
)"""


EVAL_GRID = "SELECT CAST(unnest(generate_series(4, kmax, 4)) AS INTEGER) AS k FROM kmax"


LATE_ALL = alert_sql(
    "SELECT k, 'device_' || id AS series, value FROM late_ratio",
    f"SELECT n.series, g.k FROM (SELECT DISTINCT 'device_' || id AS series FROM late_ratio) n, ({EVAL_GRID}) g", "gt", 0.25)


def _late_alert(devices) -> str:
    names = ", ".join(f"('device_{d}')" for d in devices)
    ids = ", ".join(str(d) for d in devices)
    return with_ctes(*PIPE_CTES, LATE_RATIO) + alert_sql(
        f"SELECT k, 'device_' || id AS series, value FROM late_ratio WHERE CAST(id AS INTEGER) IN ({ids})",
        f"SELECT n.series, g.k FROM (VALUES {names}) n(series), ({EVAL_GRID}) g", "gt", 0.25)


def _band(v: str, steps) -> str:
    out = "'green'"
    for thr, colour in steps:
        out = f"CASE WHEN {v} >= {thr!r}e0 THEN '{colour}' ELSE {out} END"
    return f"CASE WHEN {v} IS NULL THEN NULL ELSE {out} END"


def _panel(name: str, src: str, series: str, steps) -> str:
    return (f"SELECT '{name}' AS panel, series, round(value, 6) AS value, {_band('value', steps)} AS band "
            f"FROM (SELECT {series} AS series, arg_max(value, k) AS value FROM {src} WHERE value IS NOT NULL GROUP BY ALL)")


def _stage_ctes():
    return (SENSOR, CLASSIFIED, ON_TIME, SPEED_W2, EVK, ENRICHED_K, STAGES)


# Samples at uneven times, and evaluation by joining every time with all samples of its window.
DEVICE_SAMPLES = """
uneven AS (
  SELECT device, arrival AS ts, CAST(arg_max(total, event_id) AS DOUBLE) AS value
  FROM (SELECT *, sum(inc) OVER (PARTITION BY device, life ORDER BY event_id) AS total
        FROM (SELECT CAST(user_id AS VARCHAR) AS device, event_id, CAST(round(value * 100e0) AS BIGINT) AS inc,
                     1704067200e0 + (epoch_us(ts) - 1704067200000000) / 648000000e0 AS arrival,
                     count(*) FILTER (WHERE event_id % 40 = 0) OVER (PARTITION BY user_id ORDER BY event_id) AS life
              FROM events))
  WHERE (event_id // 200) % 5 <> 0
  GROUP BY device, arrival
),
stepped AS (
  SELECT *, lag(value) OVER (PARTITION BY device ORDER BY ts) AS was FROM uneven
),
moments AS (
  SELECT device, 1704067207e0 + j * 60e0 AS t
  FROM (SELECT device, unnest(range(CAST(ceil((min(ts) - 1704067207e0) / 60e0) AS BIGINT),
                                    CAST(floor((max(ts) + 300e0 - 1704067207e0) / 60e0) AS BIGINT) + 1)) AS j
        FROM uneven GROUP BY device)
)"""

AT_TIMES = """
seen AS (
  SELECT m.device, m.t, count(*) AS n, min(s.ts) AS a, max(s.ts) AS b, arg_min(s.value, s.ts) AS first_value,
         sum(CASE WHEN s.was IS NULL THEN 0e0 WHEN s.value < s.was THEN s.value ELSE s.value - s.was END)
           - arg_min(CASE WHEN s.was IS NULL THEN 0e0 WHEN s.value < s.was THEN s.value ELSE s.value - s.was END, s.ts) AS inc
  FROM moments m JOIN stepped s ON s.device = m.device AND s.ts >= m.t - 300e0 AND s.ts <= m.t
  GROUP BY m.device, m.t HAVING count(*) >= 2
),
edges AS (
  SELECT *, b - a AS sampled, (b - a) / (n - 1e0) AS step, a - (t - 300e0) AS before, t - b AS behind,
         CASE WHEN inc > 0 AND first_value >= 0 THEN (b - a) * (first_value / inc) END AS zero
  FROM seen
),
reach AS (
  SELECT *, CASE WHEN before >= step * 1.1e0 THEN step / 2e0 ELSE before END AS lead_in,
         CASE WHEN behind >= step * 1.1e0 THEN step / 2e0 ELSE behind END AS lead_out
  FROM edges
)"""

ORACLE_METRICS: dict[str, str] = {
    "rate_at_times": with_ctes(DEVICE_SAMPLES, AT_TIMES) + """
SELECT device, t, inc * ((sampled + CASE WHEN zero < lead_in THEN zero ELSE lead_in END + lead_out) / sampled / 300e0) AS value
FROM reach""",
    "increase_at_times": with_ctes(DEVICE_SAMPLES, AT_TIMES) + "SELECT device, t, inc / 300e0 AS value FROM seen",
    "instant_at_times": with_ctes(DEVICE_SAMPLES) + """
SELECT m.device, m.t, arg_max(s.value, s.ts) AS value
FROM moments m JOIN uneven s ON s.device = m.device AND s.ts > m.t - 300e0 AND s.ts <= m.t
GROUP BY m.device, m.t""",
    "sample_counters": with_ctes(*PIPE_CTES) + """
SELECT k, metric, CAST(nullif(id, '') AS INTEGER) AS id,
       CAST(units AS DOUBLE) / CASE WHEN metric = 'time_counter_ms' THEN 1000e0 ELSE 1e0 END AS value FROM pipe""",
    "rate_by_device": with_ctes(*PIPE_CTES, rate("r", "pipe", ["metric", "id"], window=60.0, extrapolate=False,
                                                 where=DEVICE_ONLY))
    + "SELECT k, metric, CAST(nullif(id, '') AS INTEGER) AS id, value FROM r",
    "rate_extrapolated": with_ctes(*PIPE_CTES, rate("r", "pipe", ["metric", "id"], window=300.0, where=DEVICE_ONLY))
    + "SELECT k, metric, CAST(nullif(id, '') AS INTEGER) AS id, value FROM r",
    "events_in_rate": with_ctes(*PIPE_CTES, EVENTS_IN) + "SELECT k, value FROM events_in",
    "events_out_rate": with_ctes(*PIPE_CTES, rate("r", "pipe", ["metric", "id"], where="metric = 'total_on_time_events'"))
    + "SELECT k, value FROM r",
    "late_ratio": with_ctes(*PIPE_CTES, LATE_RATIO) + "SELECT k, CAST(id AS INTEGER) AS id, value FROM late_ratio",
    "avg_processing_time": with_ctes(*PIPE_CTES, AVG_PROC) + "SELECT k, value FROM avg_proc",
    "out_in_ratio": with_ctes(*_stage_ctes()) + "SELECT k, value FROM out_in",
    "backpressure": with_ctes(EVK, BACKPRESSURE) + "SELECT task, k, value FROM bp",
    "cpu_usage": with_ctes(EVK, CPU_USAGE) + "SELECT k, instance, value FROM cpu_usage",
    "memory_usage": with_ctes(EVK, MEM_USAGE) + "SELECT k, instance, value FROM memory_usage",
    "net_rx": with_ctes(EVK, NET_RX) + "SELECT k, value FROM net_rx",
    "net_tx": with_ctes(EVK, NET_TX) + "SELECT k, value FROM net_tx",
    "swap_in": with_ctes(EVK, swap("in"), rate("r", "swap_in", ["instance"])) + "SELECT k, instance, value FROM r",
    "swap_out": with_ctes(EVK, swap("out"), rate("r", "swap_out", ["instance"])) + "SELECT k, instance, value FROM r",
    "instant_values": with_ctes(*PIPE_CTES) + """
SELECT metric, CAST(nullif(id, '') AS INTEGER) AS id,
       arg_max(CAST(units AS DOUBLE) / CASE WHEN metric = 'time_counter_ms' THEN 1000e0 ELSE 1e0 END, k) AS value
FROM pipe, kmax WHERE k <= kmax AND k > kmax - 20 GROUP BY metric, id""",
    "stat_panels": with_ctes(*PIPE_CTES, EVENTS_IN, CPU_USAGE, MEM_USAGE, NET_RX, LATE_RATIO, BACKPRESSURE,
                             rate("r_out", "pipe", ["metric", "id"], where="metric = 'total_on_time_events'"))
    + "\nUNION ALL ".join([
        _panel("events_in", "events_in", "''", [(80.0, "red")]),
        _panel("events_out", "r_out", "''", [(80.0, "red")]),
        _panel("cpu", "cpu_usage", "instance", [(80.0, "#EAB839"), (90.0, "red")]),
        _panel("memory", "memory_usage", "instance", [(80.0, "#EAB839"), (90.0, "red")]),
        _panel("net_rx", "net_rx", "''", [(80.0, "red")]),
        _panel("late_ratio", "late_ratio", "id", [(0.25, "red")]),
        _panel("backpressure", "bp", "task", [(500.0, "red")]),
    ]),
    "memory_usage_stored": with_ctes(EVK, MEM_USAGE) + """
SELECT 1704067200e0 + CAST(k AS DOUBLE) * 15e0 AS ts, '[{"key":"instance","value":"' || instance || '"}]' AS labels, value
FROM memory_usage""",
    "net_rx_stored": with_ctes(EVK, NET_RX) + "SELECT k, value FROM net_rx",
    "recent_counters": with_ctes(*PIPE_CTES) + """
SELECT 1704067200e0 + CAST(k AS DOUBLE) * 15e0 AS ts, metric, id, CAST(units AS DOUBLE) AS value
FROM pipe, kmax WHERE k > kmax - 20 AND metric <> 'time_counter_ms'""",
    "alert_backpressure": with_ctes(EVK, BACKPRESSURE) + alert_sql(
        "SELECT task AS series, k, value FROM bp",
        f"SELECT t.task AS series, g.k FROM (SELECT DISTINCT task FROM bp) t, ({EVAL_GRID}) g", "gt", 500.0),
    "alert_late_events": _late_alert((4,)),
    "alert_late_events_all": with_ctes(*PIPE_CTES, LATE_RATIO) + LATE_ALL,
    "alert_transitions": with_ctes(*PIPE_CTES, LATE_RATIO) + f"""
SELECT * FROM (SELECT k, series, value, state, lag(state) OVER (PARTITION BY series ORDER BY k) AS prev_state
               FROM ({LATE_ALL}))
WHERE prev_state IS NULL OR prev_state <> state""",
    "alert_low_output": with_ctes(*_stage_ctes()) + alert_sql(
        "SELECT 'out_in' AS series, k, value FROM out_in",
        f"SELECT 'out_in' AS series, k FROM ({EVAL_GRID})", "lt", 0.5),
}
