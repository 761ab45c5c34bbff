"""Queries that feed the streaming parts with slices of the given tables, as micro-batches would.

The slices go through the same ``foreachBatch`` functions that a stream calls, with their state in the shared folder, and the
results must equal those of the batch queries, whatever the slicing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.operators import alerts as AL
from wakeline.operators.prefix import global_row_number
from wakeline.plans import metric_queries as MQ
from wakeline.session import checkpoint_dir, materialize
from wakeline.sources import fixtures as fx
from wakeline.streaming import pipeline as P
from wakeline.streaming import state

PARTITIONS = 3
SLICES = 3


def _root(spark) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/slices-{uuid.uuid4().hex}"


def _json(s: DataFrame):
    return F.to_json(F.struct("id", "x", "y", "timestamp")).alias("value")


def _by_arrival(spark, sf_dir) -> DataFrame:
    """The sensor's records as JSON and the number of the slice that each comes in."""
    s = fx.load_sensor(spark, sf_dir)
    n = s.agg(F.max("seq")).first()[0]
    part = F.floor(F.col("seq") * SLICES / F.lit((n or 0) + 1)).cast("int")
    return materialize(s.select("seq", _json(s), part.alias("slice")))


def _classified(spark, root: str) -> DataFrame:
    on_time, late = (state.read_table(spark, root, t) for t in ("on_time", "late"))
    return on_time.withColumn("is_late", F.lit(False)).unionByName(late.withColumn("is_late", F.lit(True)))


def q_stream_partition_lateness(spark, sf_dir):
    """W0 over three source partitions of which each comes a slice later than the one before it."""
    s = fx.load_sensor(spark, sf_dir).withColumn("partition", F.col("id") % PARTITIONS)
    s = global_row_number(s, "seq", "_rn", keys=["partition"]).withColumn("offset", F.col("_rn") - 1)
    rows = materialize(s.select("partition", "offset", _json(s)))
    step = (rows.agg(F.max("offset")).first()[0] or 0) // SLICES + 1
    root = _root(spark)
    order = P.HoldBack(root, P.LatenessIngest(root), PARTITIONS)
    for i in range(SLICES + PARTITIONS - 1):
        order(rows.filter(F.floor(F.col("offset") / step) + F.col("partition") == i), i)
    order.flush(spark)
    c = _classified(spark, root)
    return c.select((F.col("seq") % PARTITIONS).cast("int").alias("partition"), F.expr(f"seq div {PARTITIONS}").alias("offset"),
                    "seq", "id", "timestamp", "is_late")


def q_stream_device_lateness(spark, sf_dir):
    """W0 per device, the maxima carried from slice to slice."""
    rows = _by_arrival(spark, sf_dir)
    root = _root(spark)
    ingest = P.LatenessIngest(root, scope="device", every=2)
    for i in range(SLICES):
        ingest(rows.filter(F.col("slice") == i).select("seq", "value"), i)
    return _classified(spark, root).select("seq", "id", "timestamp", "is_late")


def q_stream_counters(spark, sf_dir):
    """A1-A5: the counters that the stream keeps, after the last slice; one slice comes twice."""
    rows = _by_arrival(spark, sf_dir)
    root = _root(spark)
    counters = P.CounterWriter(root, P.event_bumps, every=2, clock=float)
    ingest = P.LatenessIngest(root, counters=counters)
    for i in [*range(SLICES), SLICES - 1]:
        ingest(rows.filter(F.col("slice") == i).select("seq", "value"), i)
    return counters.totals(spark)


def q_stream_alert_transitions(spark, sf_dir):
    """Changes of state of the late-ratio alerts, sent while the values come in."""
    inp = MQ.Inputs(spark, sf_dir)
    lr = MQ.late_ratio(inp)
    values = materialize(lr.select("k", F.concat(F.lit("device_"), F.col("id")).alias("series"), "value"))
    end = inp.kmax().first()[0] or 0
    root = _root(spark)
    stream = P.AlertStream(root, ["series"], "gt", AL.LATE_RATIO_LIMIT)
    bounds = [end * (i + 1) // SLICES for i in range(SLICES)]
    for i, (a, b) in enumerate(zip([0, *bounds], bounds)):
        stream(values.filter((F.col("k") > a) & (F.col("k") <= b)), i, upto=b)
    sent = state.read_table(spark, root, "alert_sent")
    return sent.select("series", "k", "value", "state", "prev_state")


STREAM_QUERIES = {
    "stream_partition_lateness": q_stream_partition_lateness,
    "stream_device_lateness": q_stream_device_lateness,
    "stream_counters": q_stream_counters,
    "stream_alert_transitions": q_stream_alert_transitions,
}
