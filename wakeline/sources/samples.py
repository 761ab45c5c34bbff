"""Metric series sampled from the event tables on the 15 s scrape grid.

Three families, each derived with fixed formulas from ``events`` (the oracle
repeats them in DuckDB):

* pipeline counters: on-time / late counts per device and in total, and the
  latency sum ``time_counter_ms`` (integer microseconds, shown in ms);
* node metrics: cpu seconds per mode, memory gauges, network bytes, swap pages;
* stage metrics: records in / out per second and a back-pressure gauge.

A counter shows at the first scrape at or after the event's ``arrival``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeline.operators import metrics as M
from wakeline.sources import fixtures as fx

START = fx.EPOCH_2024_S

# Fixed values of the node and stage formulas.
CPU_MODE = {"view": "idle", "click": "user", "purchase": "system", "signup": "iowait", "error": "irq"}
INSTANCES = 3
CPUS = 4
MEM_TOTAL_BYTES = 16000000000
MEM_BYTES_PER_CENT = 100000
NET_BYTES_PER_CENT = 10
RX_EVENT, TX_EVENT = "click", "purchase"
SWAP_IN_EVENT, SWAP_OUT_EVENT = "error", "signup"
TIME_UNITS_PER_MS = 1000.0


def _cents(v):
    return F.round(v * F.lit(100.0)).cast("long")


def indexed_events(events: DataFrame) -> DataFrame:
    """``events`` with the arrival clock and the scrape index ``k``."""
    arrival = F.lit(fx.EPOCH_2024_S) + fx._micros_since_2024(F.col("ts")) / F.lit(fx.ARRIVAL_COMPRESSION_US)
    return events.withColumn("arrival", arrival).withColumn("k", M.scrape_index(F.col("arrival"), START))


def with_k(df: DataFrame) -> DataFrame:
    return df.withColumn("k", M.scrape_index(F.col("arrival"), START))


# -- pipeline counters -------------------------------------------------------

def pipeline_bumps(classified: DataFrame, enriched: DataFrame | None) -> DataFrame:
    """``metric, id, k, inc``: every bump of a job counter (``id`` is ``''`` for totals).

    ``classified`` has ``id, arrival, is_late``; ``enriched`` has ``arrival, time_taken``
    (pass None when ``time_counter_ms`` is not needed: the speed stage is then not run).
    """
    c = with_k(classified)
    sid = F.col("id").cast("string")
    late = F.col("is_late")
    # Each event bumps two counters: its device's and the total (one pass over the events).
    pair = F.array(
        F.struct(F.concat(F.when(late, F.lit("late_device_")).otherwise(F.lit("on_time_device_")), sid)
                 .alias("metric"), sid.alias("id")),
        F.struct(F.when(late, F.lit("total_late_events")).otherwise(F.lit("total_on_time_events"))
                 .alias("metric"), F.lit("").alias("id")))
    bumps = c.select("k", F.explode(pair).alias("_c")).select(
        "_c.metric", "_c.id", "k", F.lit(1).cast("long").alias("inc"))
    if enriched is None:
        return bumps
    e = with_k(enriched)
    return bumps.unionByName(e.select(
        F.lit("time_counter_ms").alias("metric"), F.lit("").alias("id"), "k",
        F.round(F.col("time_taken").cast("double") * F.lit(1e6)).cast("long").alias("inc")))


def device_bumps(classified: DataFrame) -> DataFrame:
    """``id, kind, k, inc``: every bump of the devices' ``late`` and ``on_time`` counters, as ``pipeline_bumps`` has them."""
    kind = F.when(F.col("is_late"), F.lit("late")).otherwise(F.lit("on_time"))
    return with_k(classified).filter(F.col("id").isNotNull()).select(
        F.col("id").cast("string").alias("id"), kind.alias("kind"), "k", F.lit(1).cast("long").alias("inc"))


def _with_scale(counters: DataFrame) -> DataFrame:
    return counters.withColumn("scale", F.when(F.col("metric") == "time_counter_ms", F.lit(TIME_UNITS_PER_MS))
                               .otherwise(F.lit(1.0)))


def pipeline_counters(classified: DataFrame, enriched: DataFrame | None, kmax: DataFrame) -> DataFrame:
    """``metric, id, k, units, scale``: cumulative job counters at every scrape (see ``pipeline_bumps``)."""
    return _with_scale(M.counter_samples(pipeline_bumps(classified, enriched), ["metric", "id"], kmax))


def pipeline_totals(classified: DataFrame, enriched: DataFrame | None) -> DataFrame:
    """``metric, id, units, scale``: the job counters at the last scrape, which shows every bump."""
    return _with_scale(pipeline_bumps(classified, enriched).groupBy("metric", "id").agg(F.sum("inc").alias("units")))


# -- samples at uneven times ---------------------------------------------------

RESET_EVERY, OUTAGE_EVENTS, OUTAGE_EVERY = 40, 200, 5


def device_samples(events: DataFrame) -> DataFrame:
    """``device, ts, value``: a counter of each device's event values (cents), stored at each of its events.

    Every 40th event restarts its device's counter, and of every 1,000 events the first 200 come in an outage of the
    store: they count, but are not sampled. Of events at one time the last is stored.
    """
    e = indexed_events(events).select(F.col("user_id").cast("string").alias("device"), "event_id", "arrival",
                                      _cents(F.col("value")).alias("inc"))
    w = Window.partitionBy("device").orderBy("event_id").rowsBetween(Window.unboundedPreceding, 0)
    e = e.withColumn("life", F.sum(F.when(F.col("event_id") % RESET_EVERY == 0, 1).otherwise(0)).over(w))
    w = Window.partitionBy("device", "life").orderBy("event_id").rowsBetween(Window.unboundedPreceding, 0)
    e = e.withColumn("total", F.sum("inc").over(w))
    stored = e.filter(F.expr(f"(event_id div {OUTAGE_EVENTS}) % {OUTAGE_EVERY} != 0"))
    return stored.groupBy("device", F.col("arrival").alias("ts")).agg(
        F.max_by("total", "event_id").cast("double").alias("value"))


# -- node metrics ------------------------------------------------------------

def _instance():
    return F.concat(F.lit("node-"), (F.col("user_id") % INSTANCES).cast("string"))


def _mode():
    m = F.lit(None).cast("string")
    for et, mode in CPU_MODE.items():
        m = F.when(F.col("event_type") == et, F.lit(mode)).otherwise(m)
    return m


def node_cpu(ev: DataFrame, kmax: DataFrame) -> DataFrame:
    """``instance, cpu, mode, k, units`` (centiseconds; scale 100)."""
    inc = ev.select(_instance().alias("instance"), (F.col("user_id") % CPUS).cast("string").alias("cpu"),
                    _mode().alias("mode"), "k", _cents(F.col("value")).alias("inc"))
    return M.counter_samples(inc.filter(F.col("mode").isNotNull()), ["instance", "cpu", "mode"], kmax)


def node_network(ev: DataFrame, kmax: DataFrame, direction: str) -> DataFrame:
    """``instance, device, k, units`` (bytes) for ``direction`` in ``receive|transmit``."""
    et = RX_EVENT if direction == "receive" else TX_EVENT
    inc = ev.filter(F.col("event_type") == et).select(
        _instance().alias("instance"), F.lit("eth0").alias("device"), "k",
        (_cents(F.col("value")) * F.lit(NET_BYTES_PER_CENT)).alias("inc"))
    return M.counter_samples(inc, ["instance", "device"], kmax)


def node_swap(ev: DataFrame, kmax: DataFrame, direction: str) -> DataFrame:
    """``instance, k, units`` (pages) for ``direction`` in ``in|out``."""
    et = SWAP_IN_EVENT if direction == "in" else SWAP_OUT_EVENT
    inc = ev.filter(F.col("event_type") == et).select(_instance().alias("instance"), "k",
                                                     F.lit(1).cast("long").alias("inc"))
    return M.counter_samples(inc, ["instance"], kmax)


def node_memory(ev: DataFrame, kmax: DataFrame) -> DataFrame:
    """``instance, k, total, available`` gauges (bytes) at every scrape.

    Available memory follows the last event of the instance seen by the
    scrape (an as-of lookup done as a forward fill on the grid).
    """
    last = (ev.groupBy(_instance().alias("instance"), "k")
            .agg(F.max_by(_cents(F.col("value")), F.col("event_id")).alias("_c")))
    grid = M.gauge_grid(last.select("instance"), kmax)
    w = F.last("_c", ignorenulls=True).over(
        Window.partitionBy("instance").orderBy("k").rowsBetween(Window.unboundedPreceding, 0))
    j = grid.join(last, ["instance", "k"], "left").withColumn("_c", w)
    avail = F.lit(MEM_TOTAL_BYTES) - F.coalesce(F.col("_c"), F.lit(0)) * F.lit(MEM_BYTES_PER_CENT)
    return j.select("instance", "k", F.lit(MEM_TOTAL_BYTES).cast("double").alias("total"),
                    avail.cast("double").alias("available"))


# -- stage metrics -----------------------------------------------------------

def stage_rates(sensor_k: DataFrame, enriched_k: DataFrame, kmax: DataFrame) -> DataFrame:
    """``stage, k, value``: records per second in (source) and out (sink) per scrape interval."""
    src = sensor_k.groupBy("k").agg(F.count(F.lit(1)).alias("_n")).withColumn("stage", F.lit("source"))
    snk = enriched_k.groupBy("k").agg(F.count(F.lit(1)).alias("_n")).withColumn("stage", F.lit("sink"))
    counts = src.unionByName(snk)
    stages = F.array(F.lit("source"), F.lit("sink"))
    grid = (kmax.select(F.explode(F.sequence(F.lit(1), F.col("_kmax"))).alias("k"))
            .select(F.explode(stages).alias("stage"), "k"))
    return (grid.join(counts, ["stage", "k"], "left")
            .select("stage", "k", (F.coalesce("_n", F.lit(0)).cast("double") / F.lit(M.STEP_S)).alias("value")))


def backpressure(ev: DataFrame, kmax: DataFrame) -> DataFrame:
    """``task, k, value``: ms/s back-pressured, 10x the mean event value of the interval (0 if idle)."""
    task = F.when(F.col("user_id") % 2 == 0, F.lit("source")).otherwise(F.lit("sink"))
    per = ev.groupBy(task.alias("task"), "k").agg(F.sum(_cents(F.col("value"))).alias("_c"),
                                                   F.count(F.lit(1)).alias("_n"))
    grid = M.gauge_grid(per.select("task"), kmax)
    v = F.when(F.col("_n").isNull(), F.lit(0.0)).otherwise(
        F.col("_c").cast("double") / (F.col("_n") * 10).cast("double"))
    return grid.join(per, ["task", "k"], "left").select("task", "k", v.alias("value"))


# -- canonical long form (K12 sink format) ----------------------------------

def to_metric_samples(df: DataFrame, metric: str | None, labels: list[str], value: str = "value") -> DataFrame:
    """``ts, metric, labels, value`` rows (``metric`` column used when ``metric`` is None)."""
    m = F.col("metric") if metric is None else F.lit(metric)
    lab = F.map_from_arrays(F.array(*[F.lit(c) for c in labels]), F.array(*[F.col(c) for c in labels])) \
        if labels else F.create_map().cast("map<string,string>")
    return df.select((F.lit(START) + F.col("k").cast("double") * F.lit(M.STEP_S)).alias("ts"),
                     m.alias("metric"), lab.alias("labels"), F.col(value).cast("double").alias("value"))
