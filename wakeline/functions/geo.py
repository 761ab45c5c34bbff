"""Scalar column helpers for positions and time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the speed rule.
METRES_PER_DEGREE = 111320.0
HORIZON_S = 5.0
MIN_GAP_S = 1.0


def planar_speed(x: Column, y: Column, bx: Column, by: Column, dt: Column,
                 metres_per_degree: float = METRES_PER_DEGREE) -> Column:
    """Planar speed in m/s from two positions in degrees (no latitude correction).

    Computed in double on the (float32) coordinates, narrowed to float32.
    """
    dx = x.cast("double") - bx.cast("double")
    dy = y.cast("double") - by.cast("double")
    dist = F.sqrt(dx * dx + dy * dy)
    return (dist * F.lit(metres_per_degree) / dt).cast("float")


def latency_seconds(ts: Column, now: Column | float | None = None) -> Column:
    """``now - ts`` in seconds, narrowed to float32; ``now`` defaults to the batch clock."""
    if now is None:
        now_col = F.unix_micros(F.current_timestamp()) / F.lit(1e6)
    elif isinstance(now, Column):
        now_col = now
    else:
        now_col = F.lit(float(now))
    return (now_col - ts).cast("float")


def epoch_to_timestamp(ts: Column) -> Column:
    """Epoch seconds (double) to TIMESTAMP, rounded half-even to the microsecond."""
    return F.timestamp_micros(F.rint(ts * F.lit(1e6)).cast("long"))


def to_fixed_1(v: Column) -> Column:
    """One-decimal text of a number, as a browser's toFixed(1): the exact binary value is rounded, ties away from 0.

    ``round`` works on the shortest decimal text instead (1.45 is really 1.4499...). The fraction of a double is a
    whole number of 2**-57ths wherever it can matter, so whole-number arithmetic is exact.
    """
    a = F.abs(v.cast("double"))
    whole = F.floor(a).cast("long")
    units = ((a - F.floor(a)) * F.lit(float(1 << 57))).cast("long")
    tenths = F.call_function("div", units * F.lit(20) + F.lit(1 << 57), F.lit(1 << 58))
    text = F.concat((whole + F.call_function("div", tenths, F.lit(10))).cast("string"), F.lit("."), (tenths % 10).cast("string"))
    # From 2**53 on there is no fraction.
    return F.when(a < F.lit(9007199254740992.0), F.concat(F.when(v < 0, "-").otherwise(""), text)).otherwise(
        F.format_string("%.1f", v.cast("double")))
