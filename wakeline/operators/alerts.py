"""Threshold alerts with a hold time, evaluated on a fixed grid.

States per series and evaluation time: ``nodata`` (no value), ``error``
(evaluation failed), ``ok``, ``pending`` (breaching for less than ``hold``) and ``firing`` (breaching for at
least ``hold``). Consecutive breaching evaluations form an island; the island
is found with a running count of non-breaching evaluations (gaps and islands),
so the state needs no row-by-row loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.operators.metrics import STEP_S, _with_scalar

# Fixed values of the alert rules.
EVAL_EVERY_S = 60.0
HOLD_S = 60.0
BACKPRESSURE_LIMIT_MS = 500.0
LATE_RATIO_LIMIT = 0.25
OUT_IN_FLOOR = 0.5
LATE_ALERT_DEVICES_AS_CODED = (4,)

_OPS = {
    "gt": lambda v, t: v > F.lit(t),
    "lt": lambda v, t: v < F.lit(t),
    "ge": lambda v, t: v >= F.lit(t),
    "le": lambda v, t: v <= F.lit(t),
}


def threshold(v: Column, op: str, limit: float) -> Column:
    """Breach predicate (NULL stays NULL)."""
    return _OPS[op](v, float(limit))


def eval_every(every: float = EVAL_EVERY_S, step: float = STEP_S) -> int:
    """Scrapes from one evaluation to the next."""
    return int(round(every / step))


def eval_grid(kmax: DataFrame, every: float = EVAL_EVERY_S, step: float = STEP_S,
              series: Sequence[str] = (), series_df: DataFrame | None = None, k: str = "k") -> DataFrame:
    """Evaluation indices (every ``every`` seconds on the scrape grid) up to the grid end.

    Without ``series_df`` one unnamed series is evaluated; with it, every listed series.
    """
    e = eval_every(every, step)
    base = series_df.select(*series).distinct() if series_df is not None else None
    if base is None:
        return kmax.select(F.explode(F.sequence(F.lit(e), F.col("_kmax"), F.lit(e))).alias(k))
    return _with_scalar(base, kmax).select(*series, F.explode(
        F.sequence(F.lit(e), F.col("_kmax"), F.lit(e))).alias(k))


def alert_states(values: DataFrame, grid: DataFrame, series: Sequence[str], op: str, limit: float,
                 hold: float = HOLD_S, step: float = STEP_S, k: str = "k",
                 value: str = "value", error: str | None = None) -> DataFrame:
    """State per series and evaluation time.

    ``values`` has the reduced value per (series, k); ``grid`` the evaluation
    points. Missing values give ``nodata`` (and end an island). ``error`` names
    a boolean column of ``values`` that tells a failed evaluation: its state is
    ``error`` whatever its value, and it ends an island too.
    """
    series = list(series)
    keys = [*series, k]
    failed = F.lit(False) if error is None else F.coalesce(F.col(error), F.lit(False))
    j = grid.join(values.select(*keys, value, failed.alias("_failed")), keys, "left")
    failed = F.coalesce(F.col("_failed"), F.lit(False))
    breach = ~failed & F.coalesce(threshold(F.col(value), op, limit), F.lit(False))
    w = Window.partitionBy(*series).orderBy(k).rowsBetween(Window.unboundedPreceding, 0)
    j = j.withColumn("_breach", breach).withColumn(
        "_island", F.sum(F.when(F.col("_breach"), 0).otherwise(1)).over(w))
    wi = Window.partitionBy(*series, "_island").orderBy(k).rowsBetween(Window.unboundedPreceding, 0)
    # The island's first breaching row is the one after its opening non-breach row.
    first_breach = F.min(F.when(F.col("_breach"), F.col(k))).over(wi)
    held = (F.col(k) - first_breach).cast("double") * F.lit(step)
    state = (F.when(failed, F.lit("error"))
             .when(F.col(value).isNull(), F.lit("nodata"))
             .when(~F.col("_breach"), F.lit("ok"))
             .when(held >= F.lit(hold), F.lit("firing"))
             .otherwise(F.lit("pending")))
    return j.select(*keys, value, state.alias("state"))


def transitions(states: DataFrame, series: Sequence[str], k: str = "k") -> DataFrame:
    """Rows where a series' state changes (what a notifier would be sent)."""
    w = Window.partitionBy(*series).orderBy(k)
    prev = F.lag("state").over(w)
    return states.withColumn("prev_state", prev).filter(
        F.col("prev_state").isNull() | (F.col("prev_state") != F.col("state")))
