"""Metric series sampled on a scrape grid and the
dashboard's time-series functions, as DataFrame plans.

A series is identified by string columns (``metric`` plus label columns, ``''``
for an absent label); samples sit on an integer scrape index ``k`` (time
``start + step * k``). Counters are carried as exact integer ``units`` with a
per-metric ``scale`` (value = units / scale), so increases and sums do not
depend on summation order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STEP_S = 15.0          # scrape interval
_UNB = Window.unboundedPreceding


def scrape_index(t: Column, start: float, step: float = STEP_S) -> Column:
    """Index of the first scrape at or after time ``t`` (a counter bumped at t shows there)."""
    return F.greatest(F.lit(1), F.ceil((t - F.lit(start)) / F.lit(step))).cast("int")


def grid_end(indexed: DataFrame, k: str = "k") -> DataFrame:
    """One-row frame ``_kmax``: the last scrape index of the data."""
    return indexed.agg(F.max(k).alias("_kmax"))


def _with_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row (bounded broadcast)."""
    return (df.withColumn("_one", F.lit(1))
            .join(F.broadcast(one_row.withColumn("_one", F.lit(1))), "_one").drop("_one"))


def counter_samples(increments: DataFrame, series: Sequence[str], kmax: DataFrame,
                    inc: str = "inc", k: str = "k") -> DataFrame:
    """Cumulative counter per series at every scrape from its first bump to the grid end.

    ``increments`` holds one row per bump (``series..., k, inc``). Bumps are
    pre-aggregated per (series, k) (map-side partial aggregation, so a hot
    series costs one row per task and scrape); one window then gives the
    running total at each bumped scrape and the next bumped scrape, and each
    total is repeated over the scrapes up to the next bump. Rows per series
    are bounded by the number of scrapes, not by the number of events.
    """
    series = list(series)
    per_k = increments.groupBy(*series, k).agg(F.sum(inc).alias("_inc"))
    w = Window.partitionBy(*series).orderBy(k)
    cum = (per_k.withColumn("units", F.sum("_inc").over(w.rowsBetween(_UNB, 0)).cast("long"))
           .withColumn("_next", F.lead(k).over(w)))
    cum = _with_scalar(cum, kmax)
    upto = F.coalesce(F.col("_next") - 1, F.col("_kmax"))
    return cum.select(*series, F.explode(F.sequence(F.col(k), upto)).alias(k), "units")


def gauge_grid(series_df: DataFrame, kmax: DataFrame, k: str = "k") -> DataFrame:
    """Every series of ``series_df`` at every scrape index 1..grid end."""
    cols = series_df.columns
    return _with_scalar(series_df.distinct(), kmax).select(
        *cols, F.explode(F.sequence(F.lit(1), F.col("_kmax"))).alias(k))


def rate(samples: DataFrame, series: Sequence[str], value: str = "units", scale: float = 1.0,
         window: float = 300.0, step: float = STEP_S, extrapolate: bool = True,
         is_counter: bool = True, k: str = "k", out: str = "value", dense: bool = False,
         left_open: bool = False) -> DataFrame:
    """Per-second rate of a counter over ``[t - window, t]`` at each sample time ``t``.

    ``left_open`` leaves out a sample at ``t - window`` itself, as newer stores do.

    Counter resets are handled (a drop counts as a restart from zero); fewer
    than two samples give no row. ``extrapolate=False`` divides the raw
    increase by the window; ``extrapolate=True`` extends it towards the window
    edges the way the public Prometheus rule does (an edge gap counts only if
    shorter than 1.1 average intervals, else half an interval; the start is
    never extended past the counter's zero point).
    """
    series = list(series)
    m = int(round(window / step))
    reach = m - 1 if left_open else m
    w = Window.partitionBy(*series).orderBy(k).rangeBetween(-reach, 0)
    wl = Window.partitionBy(*series).orderBy(k)
    v = F.col(value)
    prev = F.lag(value).over(wl)
    d = samples.withColumn("_delta", F.when(prev.isNull(), F.lit(None))
                           .when(v < prev, v).otherwise(v - prev))
    if dense:
        # Series with one sample at every index from their first to their last:
        # the window is the last reach+1 rows, so running sums and fixed lags give
        # the same numbers as the range frame at constant cost per row.
        run = wl.rowsBetween(_UNB, 0)
        d = (d.withColumn("_cum", F.sum(F.coalesce("_delta", F.lit(0))).over(run))
             .withColumn("_rn", F.row_number().over(wl)))
        n = F.least(F.col("_rn"), F.lit(reach + 1))
        d = d.select(*series, k, v.alias("_v"), n.alias("_n"),
                     (F.col(k) - (n - 1)).alias("_k0"),
                     F.coalesce(F.lag(value, reach).over(wl), F.first(value).over(run)).alias("_first"),
                     (F.col("_cum") - F.coalesce(F.lag("_cum", reach).over(wl), F.lit(0))).alias("_incu"))
    else:
        d = d.select(*series, k, v.alias("_v"),
                     F.count(F.lit(1)).over(w).alias("_n"),
                     F.first(k).over(w).alias("_k0"),
                     F.first(value).over(w).alias("_first"),
                     (F.sum("_delta").over(w) - F.coalesce(F.first("_delta").over(w), F.lit(0))).alias("_incu"))
    d = d.filter(F.col("_n") >= 2)
    value = _per_second(F.col(k), F.col("_k0"), F.col("_n"), F.col("_first"), F.col("_incu"), scale, window, step, extrapolate,
                        is_counter)
    return d.select(*series, k, value.alias(out))


def _per_second(k: Column, k0: Column, n: Column, first: Column, incu: Column, scale: float, window: float, step: float,
                extrapolate: bool = True, is_counter: bool = True) -> Column:
    """Rate at ``k`` of the ``n`` samples from ``k0`` on, of which the first is ``first`` and which rise by ``incu`` units."""
    inc = incu / F.lit(float(scale))
    if not extrapolate:
        return inc / F.lit(float(window))
    sampled = (k - k0).cast("double") * F.lit(step)
    avg = sampled / (n - 1).cast("double")
    thr = avg * F.lit(1.1)
    to_start = (k0 - (k - F.lit(int(round(window / step))))).cast("double") * F.lit(step)
    to_start = F.when(to_start >= thr, avg / F.lit(2.0)).otherwise(to_start)
    if is_counter:
        first_v = first / F.lit(float(scale))
        to_zero = F.when((inc > 0) & (first_v >= 0), sampled * (first_v / inc))
        to_start = F.when(to_zero.isNotNull() & (to_zero < to_start), to_zero).otherwise(to_start)
    to_end = F.lit(0.0)  # evaluated at sample times: the last sample is at t
    factor = (sampled + to_start + to_end) / sampled / F.lit(float(window))
    return inc * factor


def counter_rates(increments: DataFrame, series: Sequence[str], kind: str, kinds: Sequence[str], kmax: DataFrame,
                  window: float = 300.0, step: float = STEP_S, scale: float = 1.0, inc: str = "inc", k: str = "k",
                  every: int = 1) -> DataFrame:
    """``series.., k`` and a column per counter of ``kinds``: its rate there, null where it has none.

    The numbers are those of ``rate(counter_samples(...), dense=True)``, but no row per scrape is sorted or shuffled: what a
    rate reads changes at a bump's scrape and when the bump leaves the window, so the counters' state is carried over these
    rows only, at most two a bump, and its scrapes are filled in at the end. With ``every`` only scrapes that it divides are
    filled in, and the grid's end, where every series has a row.
    """
    series = list(series)
    m = int(round(window / step))
    points = F.explode(F.array(F.struct(F.col(k).alias(k), F.lit(False).alias("left")),
                               F.struct((F.col(k) + m).alias(k), F.lit(True).alias("left"))))
    moved = increments.select(*series, kind, inc, points.alias("_p")).select(*series, kind, inc, "_p.*")
    cells = moved.groupBy(*series, k).agg(*[
        F.sum(F.when((F.col(kind) == x) & (F.col("left") == left), F.col(inc))).alias(f"_{x}_{name}")
        for x in kinds for name, left in (("in", False), ("out", True))])
    w = Window.partitionBy(*series).orderBy(k)
    run = w.rowsBetween(_UNB, 0)
    state = []
    for x in kinds:
        come, gone = F.col(f"_{x}_in"), F.col(f"_{x}_out")
        # Units here and a window ago, and scrape and units of the first sample.
        state += [F.sum(come).over(run).alias(f"_{x}_v"), F.sum(gone).over(run).alias(f"_{x}_old"),
                  F.min(F.when(come.isNotNull(), F.col(k))).over(run).alias(f"_{x}_k1"),
                  F.first(come, ignorenulls=True).over(run).alias(f"_{x}_v1")]
    spans = _with_scalar(cells.select(*series, F.col(k).alias("_from"), F.lead(k).over(w).alias("_next"), *state), kmax)
    spans = spans.filter(F.col("_from") <= F.col("_kmax"))
    scrapes = F.sequence("_from", F.least(F.coalesce(F.col("_next") - 1, F.col("_kmax")), F.col("_kmax")))
    if every > 1:
        scrapes = F.filter(scrapes, lambda x: (x % every == 0) | (x == F.col("_kmax")))
    at, out = F.col(k), []
    for x in kinds:
        v, old, k1, v1 = (F.col(f"_{x}_{c}") for c in ("v", "old", "k1", "v1"))
        # Null before the second sample, and so is all that follows from it.
        n = F.when(at > k1, F.least(at - k1 + 1, F.lit(m + 1)))
        first = F.coalesce(old, v1)
        out.append(_per_second(at, at - (n - 1), n, first, v - first, scale, window, step).alias(x))
    rest = [c for c in spans.columns if c not in ("_from", "_next", "_kmax")]
    return spans.select(*rest, F.explode(scrapes).alias(k)).select(*series, k, *out)


# -- stored samples at any evaluation times ------------------------------------

def evaluation_times(samples: DataFrame, series: Sequence[str], start: float, every: float,
                     keep: float = 300.0, ts: str = "ts") -> DataFrame:
    """``series.., t``: times ``start + j * every`` from each series' first sample to ``keep`` seconds after its last."""
    ends = samples.groupBy(*series).agg(F.min(ts).alias("_a"), F.max(ts).alias("_b"))
    index = lambda t: (t - F.lit(float(start))) / F.lit(float(every))
    low, high = F.ceil(index(F.col("_a"))), F.floor(index(F.col("_b") + F.lit(float(keep))))
    return ends.filter(low <= high).select(*series, F.explode(F.sequence(low, high)).alias("_j")).select(
        *series, (F.lit(float(start)) + F.col("_j").cast("double") * F.lit(float(every))).alias("t"))


def _as_of(samples: DataFrame, grid: DataFrame, series: Sequence[str], window: float | None, columns: Sequence[str],
           ts: str) -> DataFrame:
    """``series.., t, _end, _start``: of each series, the last sample at or before t, and the first at or after t - window.

    Samples and probes share one order per series; the last sample seen by a probe in ascending (descending) time
    is what it asks for, so a row costs the same however many samples the window holds.
    """
    data = F.struct(F.col(ts).alias("ts"), *columns)
    kinds = [(1, F.col("t"))] + ([] if window is None else [(2, F.col("t") - F.lit(float(window)))])
    rows = samples.select(*series, F.col(ts).alias("_t"), F.lit(0).alias("_kind"), data.alias("_s"), F.lit(None).cast("double").alias("t"))
    probes = grid.select(*series, "t", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), at.alias("at")) for k, at in kinds])).alias("_p"))
    rows = rows.unionByName(probes.select(*series, F.col("_p.at").alias("_t"), F.col("_p.k").alias("_kind"),
                                          F.lit(None).cast(rows.schema["_s"].dataType).alias("_s"), "t"))
    w = Window.partitionBy(*series)
    before = w.orderBy(F.col("_t").asc(), F.col("_kind").asc()).rowsBetween(_UNB, 0)
    after = w.orderBy(F.col("_t").desc(), F.col("_kind").asc()).rowsBetween(_UNB, 0)
    rows = rows.withColumn("_end", F.when(F.col("_kind") == 1, F.last("_s", ignorenulls=True).over(before)))
    start = F.lit(None).cast(rows.schema["_s"].dataType)
    if window is not None:
        start = F.when(F.col("_kind") == 2, F.last("_s", ignorenulls=True).over(after))
    rows = rows.withColumn("_start", start).filter("_kind > 0")
    return rows.groupBy(*series, "t").agg(F.first("_end", ignorenulls=True).alias("_end"),
                                          F.first("_start", ignorenulls=True).alias("_start"))


def instant_at(samples: DataFrame, grid: DataFrame, series: Sequence[str], lookback: float = 300.0,
               ts: str = "ts", value: str = "value") -> DataFrame:
    """``series.., t, value``: the latest sample at or before t that is not older than ``lookback``."""
    found = _as_of(samples, grid, series, None, [F.col(value).alias("v")], ts)
    fresh = F.col("_end.ts") > F.col("t") - F.lit(float(lookback))
    return found.filter(fresh).select(*series, "t", F.col("_end.v").alias("value"))


def rate_at(samples: DataFrame, grid: DataFrame, series: Sequence[str], window: float = 300.0, extrapolate: bool = True,
            is_counter: bool = True, ts: str = "ts", value: str = "value") -> DataFrame:
    """M1-M2 for stored samples at the times of ``grid`` (series.., t), which need not be sample times.

    Over the samples in ``[t - window, t]``: a drop of the counter is a restart from zero, fewer than two samples give
    no row. ``extrapolate`` extends the increase to both ends of the window by the public Prometheus rule: an end
    further from the nearest sample than 1.1 average intervals counts half an interval, and a counter is not extended
    back beyond its zero.
    """
    series = list(series)
    w = Window.partitionBy(*series).orderBy(ts)
    v, prev = F.col(value), F.lag(value).over(w)
    delta = F.when(prev.isNull(), F.lit(0.0)).when(v < prev, v).otherwise(v - prev)
    summed = samples.select(*series, ts, v.alias("v"), delta.alias("_d"), F.row_number().over(w).alias("i")).withColumn(
        "cum", F.sum("_d").over(w.rowsBetween(_UNB, 0)))
    d = _as_of(summed, grid, series, window, ["v", "i", "cum"], ts)
    n = F.col("_end.i") - F.col("_start.i") + 1
    d = d.filter(n >= 2).select(*series, "t", n.cast("double").alias("_n"), F.col("_start.ts").alias("_a"), F.col("_end.ts").alias("_b"),
                                F.col("_start.v").alias("_first"), (F.col("_end.cum") - F.col("_start.cum")).alias("_inc"))
    inc, width = F.col("_inc"), F.lit(float(window))
    if not extrapolate:
        return d.select(*series, "t", (inc / width).alias("value"))
    sampled = F.col("_b") - F.col("_a")
    avg = sampled / (F.col("_n") - F.lit(1.0))
    to_start, to_end = F.col("_a") - (F.col("t") - width), F.col("t") - F.col("_b")
    to_start = F.when(to_start >= avg * F.lit(1.1), avg / F.lit(2.0)).otherwise(to_start)
    if is_counter:
        to_zero = F.when((inc > 0) & (F.col("_first") >= 0), sampled * (F.col("_first") / inc))
        to_start = F.when(to_zero.isNotNull() & (to_zero < to_start), to_zero).otherwise(to_start)
    to_end = F.when(to_end >= avg * F.lit(1.1), avg / F.lit(2.0)).otherwise(to_end)
    return d.select(*series, "t", (inc * ((sampled + to_start + to_end) / sampled / width)).alias("value"))


def sum_by(df: DataFrame, by: Sequence[str] = (), value: str = "value", k: str = "k") -> DataFrame:
    """``sum by(...)`` across series at each time."""
    return df.groupBy(k, *by).agg(F.sum(value).alias(value))


def avg_by(df: DataFrame, by: Sequence[str], value: str = "value", k: str = "k") -> DataFrame:
    """``avg by(...)`` across series at each time."""
    return df.groupBy(k, *by).agg(F.avg(value).alias(value))


def binary_match(a: DataFrame, b: DataFrame, on: Sequence[str], op, k: str = "k",
                 value: str = "value") -> DataFrame:
    """One-to-one vector match on ``k`` and the ``on`` labels (inner: unmatched sides vanish).

    ``on`` columns must hold ``''`` for an absent label, so absent-on-both matches.
    """
    keys = [k, *on]
    l = a.select(*keys, F.col(value).alias("_a"))
    r = b.select(*keys, F.col(value).alias("_b"))
    return l.join(r, keys, "inner").select(*keys, op(F.col("_a"), F.col("_b")).alias(value))


def last_value(df: DataFrame, series: Sequence[str], value: str = "value", k: str = "k") -> DataFrame:
    """Last non-null value per series (stat panel ``lastNotNull``, alert reducer ``last``)."""
    return (df.filter(F.col(value).isNotNull()).groupBy(*series)
            .agg(F.max_by(value, k).alias(value)))


def instant(df: DataFrame, series: Sequence[str], at_k: Column, lookback_steps: int = 20,
            value: str = "value", k: str = "k") -> DataFrame:
    """Value of each series at evaluation index ``at_k`` (latest sample within the lookback)."""
    win = df.filter((F.col(k) <= at_k) & (F.col(k) > at_k - F.lit(lookback_steps)))
    return win.groupBy(*series).agg(F.max_by(value, k).alias(value))


def band(v: Column, steps: Sequence[tuple[float, str]], base: str = "green") -> Column:
    """Colour of ``v`` for threshold steps ``[(value, colour), ...]`` (ascending)."""
    out = F.lit(base)
    for thr, colour in steps:
        out = F.when(v >= F.lit(float(thr)), F.lit(colour)).otherwise(out)
    return F.when(v.isNull(), F.lit(None)).otherwise(out)


# -- canonical sample form: ts, metric, labels MAP<STRING,STRING>, value ------

def select_series(samples: DataFrame, metric: str, **labels: str) -> DataFrame:
    """Series of ``metric`` whose labels equal the given values (``mode="idle"``...)."""
    cond = F.col("metric") == F.lit(metric)
    for k, v in labels.items():
        cond = cond & (F.col("labels").getItem(k) == F.lit(v))
    return samples.filter(cond)


def label_key(labels: Column) -> Column:
    """Canonical text of a label map (sorted by name), to match series on all labels."""
    return F.to_json(F.array_sort(F.map_entries(labels)))


def label_column(labels: Column, name: str) -> Column:
    """A label as a matching key: ``''`` when absent, so absent-on-both sides match."""
    return F.coalesce(labels.getItem(name), F.lit(""))


def time_range(samples: DataFrame, now: float | Column, seconds: float, ts: str = "ts") -> DataFrame:
    """Samples in the relative range ``(now - seconds, now]`` (e.g. a dashboard's last 5 min)."""
    now = now if isinstance(now, Column) else F.lit(float(now))
    return samples.filter((F.col(ts) > now - F.lit(float(seconds))) & (F.col(ts) <= now))


def scrape_series(samples: DataFrame, labels: Sequence[str], start: float, step: float = STEP_S) -> DataFrame:
    """Stored samples in the form of the functions above: a column per label, ``k`` and ``value``."""
    return samples.select(*[label_column(F.col("labels"), c).alias(c) for c in labels],
                          F.round((F.col("ts") - F.lit(start)) / F.lit(step)).cast("int").alias("k"), "value")


def match_all_labels(a: DataFrame, b: DataFrame, op) -> DataFrame:
    """One-to-one match of stored samples on time and all labels: ``ts, labels`` (as text), ``value``."""
    side = lambda df: df.select("ts", label_key(F.col("labels")).alias("labels"), "value")
    return binary_match(side(a), side(b), ["labels"], op, k="ts")


def read_metric_samples(spark, path: str, fmt: str = "parquet") -> DataFrame:
    """Stored samples in the canonical form (written by ``write_metric_samples``)."""
    from wakeline.schemas import METRIC_SAMPLE

    return spark.read.format(fmt).schema(METRIC_SAMPLE).load(path)


def write_metric_samples(samples: DataFrame, path: str, day_seconds: float = 86400.0) -> None:
    """Append canonical samples, partitioned by day of ``ts`` (cheap time pruning on read)."""
    (samples.withColumn("day", F.floor(F.col("ts") / F.lit(day_seconds)).cast("long"))
     .write.mode("append").partitionBy("day").parquet(path))
