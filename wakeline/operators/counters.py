"""Event counters per device and in total, and the latency sum.

All are plain aggregations: partial (map-side) aggregation keeps the shuffle at
one row per device per task, however skewed the devices are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_by_device(df: DataFrame, key: str = "id") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def count_total(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def time_counter_ms(enriched: DataFrame) -> DataFrame:
    """Sum of ``time_taken * 1000`` over enriched rows (float32 ``time_taken``)."""
    return enriched.agg(F.sum(F.col("time_taken").cast("double") * F.lit(1000.0)).alias("ms"))


def device_counters_long(classified: DataFrame, enriched: DataFrame, key: str = "id") -> DataFrame:
    """Every counter the job exports, as ``metric, value`` rows.

    Per-device names are made on first sight of a key: ``on_time_device_<id>``,
    ``late_device_<id>``; totals ``total_on_time_events``, ``total_late_events``
    (0 where there is no such event), and ``time_counter_ms``. ``classified`` has
    ``is_late``; its events are counted once, and the totals come from the devices' counts.
    """
    late = F.col("is_late")
    device = F.concat(F.when(late, "late_device_").otherwise("on_time_device_"), F.col(key).cast("string"))
    total = F.when(late, "total_late_events").otherwise("total_on_time_events")
    counts = (classified.groupBy("is_late", key).agg(F.count(F.lit(1)).alias("n"))
              .select(F.explode(F.array(device, total)).alias("metric"), "n"))
    totals = F.array(F.lit("total_on_time_events"), F.lit("total_late_events"))
    zero = classified.sparkSession.range(1).select(F.explode(totals).alias("metric"), F.lit(0).cast("long").alias("n"))
    ms = time_counter_ms(enriched).select(F.lit("time_counter_ms").alias("metric"),
                                          F.coalesce(F.col("ms"), F.lit(0.0)).alias("value"))
    return (counts.unionByName(zero).groupBy("metric").agg(F.sum("n").cast("double").alias("value"))
            .unionByName(ms))


def device_counters_wide(df: DataFrame, ids, key: str = "id", prefix: str = "on_time_device_") -> DataFrame:
    """A6 wide form: one column ``<prefix><id>`` per listed device (pivot over given values,
    so no distinct values are collected to the driver)."""
    vals = [int(i) for i in ids]
    p = df.groupBy().pivot(key, vals).agg(F.count(F.lit(1)))
    return p.select(*[F.coalesce(F.col(str(v)), F.lit(0)).alias(f"{prefix}{v}") for v in vals])
