"""Split events into on-time and late by a running maximum of event time.

An event is on time iff its timestamp is strictly greater than every earlier
timestamp (in arrival order ``seq``), starting from ``start``. Equal
timestamps are late, NaN is always late and never advances the maximum,
+Infinity advances it. ``scope="stream"`` keeps one maximum over all devices
(the reference's behaviour); ``scope="device"`` keeps one per device.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.operators.prefix import DEFAULT_BUCKET_ROWS, DEFAULT_LEVELS, Buckets, running_max_before


def classify_lateness(df: DataFrame, seq: str = "seq", ts: str = "timestamp",
                      scope: str = "stream", start: float | str = 0.0,
                      bucket_rows: int | Buckets = DEFAULT_BUCKET_ROWS, key: str = "id",
                      levels: int = DEFAULT_LEVELS) -> DataFrame:
    """Add ``is_late`` (boolean) to ``df``; ``levels`` as in ``prefix.scan_before``.

    ``start`` is the maximum before the first event, or names a column with each row's own (null: 0).
    """
    if scope not in ("stream", "device"):
        raise ValueError(f"scope must be 'stream' or 'device', not {scope!r}")
    keys = [key] if scope == "device" else []
    t = F.col(ts)
    d = df.withColumn("_tmax", F.when(F.isnan(t), F.lit(None)).otherwise(t))
    d = running_max_before(d, "_tmax", seq, "_prev", keys=keys, bucket_rows=bucket_rows, levels=levels)
    first = F.coalesce(F.col(start), F.lit(0.0)) if isinstance(start, str) else F.lit(float(start))
    prev = F.greatest(first, F.col("_prev"))
    on_time = t.isNotNull() & ~F.isnan(t) & (t > prev)
    return d.withColumn("is_late", ~on_time).drop("_tmax", "_prev")


def split_late(df: DataFrame, **kw) -> tuple[DataFrame, DataFrame]:
    """Return ``(on_time, late)`` frames (the main output and the side output)."""
    c = classify_lateness(df, **kw)
    return (c.filter(~F.col("is_late")).drop("is_late"),
            c.filter(F.col("is_late")).drop("is_late"))
