"""Wire the streaming queries of the job together.

    raw stream --foreachBatch--> on_time / late / quarantine tables (+ lateness carry), event counters
               --foreachBatch--> archive (exact n-record JSON arrays)
    on_time table stream --ListState speed--> enriched table (file sink, exactly once)
    enriched table stream --foreachBatch--> readings table, latest-per-device table, latency counter

Each query has its own checkpoint under ``<root>/_checkpoints``; ``root`` should
be a shared folder on a cluster.
"""

from __future__ import annotations

import os

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import wakeline
from wakeline.operators.speed import with_time_taken
from wakeline.schemas import ENRICHED
from wakeline.streaming import pipeline as P

ENRICHED_TABLE = "enriched"


def _ckpt(root: str, name: str) -> str:
    return os.path.join(root, "_checkpoints", name)


def _trigger(w, available_now: bool, interval: str | None):
    if available_now:
        return w.trigger(availableNow=True)
    if interval:
        return w.trigger(processingTime=interval)
    return w


class Ingested:
    """What the queries on the raw stream leave to do once it has stopped."""

    def __init__(self, archive: P.ArchiveWriter, held: list[P.HoldBack]):
        self.archive, self.held = archive, held

    def flush(self, spark: SparkSession) -> None:
        """Let held-back records go, then write the archive's last partial batch."""
        for h in self.held:
            h.flush(spark)
        self.archive.flush(spark)


def counters(root: str, **kw) -> P.CounterWriter:
    """The job's event counters (table ``counters``)."""
    return P.CounterWriter(root, P.event_bumps, **kw)


def latency_counter(root: str, **kw) -> P.CounterWriter:
    """The job's latency sum (table ``latency_counter``)."""
    return P.CounterWriter(root, P.latency_bumps, "latency_counter", **kw)


def start_ingest(raw: DataFrame, root: str, available_now: bool = False, interval: str | None = None,
                 archive_batch: int = 200, partitions: int | None = None, start: dict[int, int] | None = None,
                 scope: str = "stream"):
    """Queries on the raw stream: lateness split with the event counters, and archive.

    With ``partitions`` the raw stream has columns ``partition`` and ``offset`` too, and both queries see its records
    in one order (``HoldBack``), from the offsets in ``start`` on.
    """
    ingest = P.LatenessIngest(root, scope=scope, counters=counters(root))
    writer = P.ArchiveWriter(root, n=archive_batch)
    sinks, held = [ingest, writer], []
    if partitions:
        held = [P.HoldBack(root, sink, partitions, start, f"order_{name}") for sink, name in zip(sinks, ("ingest", "archive"))]
        sinks = held
    q1, q2 = (_trigger(raw.writeStream.foreachBatch(sink).option("checkpointLocation", _ckpt(root, name)),
                       available_now, interval).start() for sink, name in zip(sinks, ("ingest", "archive")))
    return q1, q2, Ingested(writer, held)


def start_speed(spark: SparkSession, root: str, available_now: bool = False, interval: str | None = None,
                ttl_ms: int | None = None, idle_s: float | None = None):
    """Enriched stream from the on-time table; ``time_taken`` from the batch clock.

    ``idle_s``: clear the state of devices that are silent so long (see ``pipeline.speed_stream``).

    Every micro-batch takes all files there are: an ingest batch's folder appears as a whole, and a limit on
    files would cut it in parts that may be read out of order.
    """
    # The processor runs in a worker that does not see files added to the session, so it travels by value.
    cloudpickle.register_pickle_by_value(wakeline)
    on_time = spark.readStream.schema(P.ON_TIME_SCHEMA).parquet(os.path.join(root, "on_time"))
    enriched = with_time_taken(P.speed_stream(on_time, ttl_ms=ttl_ms, idle_s=idle_s))
    enriched = enriched.select(*[F.col(f.name) for f in ENRICHED.fields], "seq")
    w = (enriched.writeStream.format("parquet").option("checkpointLocation", _ckpt(root, "speed"))
         .option("path", os.path.join(root, ENRICHED_TABLE)))
    return _trigger(w, available_now, interval).start()


def start_sinks(spark: SparkSession, root: str, available_now: bool = False, interval: str | None = None):
    """Readings, latest-per-device and the latency counter from the enriched table."""
    sch = ENRICHED.add("seq", "long")
    src = spark.readStream.schema(sch).parquet(os.path.join(root, ENRICHED_TABLE))
    q1 = _trigger(src.writeStream.foreachBatch(P.ReadingsWriter(root))
                  .option("checkpointLocation", _ckpt(root, "readings")), available_now, interval).start()
    q2 = _trigger(src.writeStream.foreachBatch(P.LatestUpsert(root))
                  .option("checkpointLocation", _ckpt(root, "latest")), available_now, interval).start()
    q3 = _trigger(src.writeStream.foreachBatch(latency_counter(root))
                  .option("checkpointLocation", _ckpt(root, "latency_counter")), available_now, interval).start()
    return q1, q2, q3


def run_available(spark: SparkSession, raw: DataFrame, root: str, timeout_s: int = 3600, **ingest) -> None:
    """Process everything available now, stage by stage (backfill / tests), then flush what is held back."""
    q1, q2, rest = start_ingest(raw, root, available_now=True, **ingest)
    for q in (q1, q2):
        q.awaitTermination(timeout_s)
    rest.flush(spark)
    start_speed(spark, root, available_now=True).awaitTermination(timeout_s)
    for q in start_sinks(spark, root, available_now=True):
        q.awaitTermination(timeout_s)
