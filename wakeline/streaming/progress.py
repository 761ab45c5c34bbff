"""M8 from the engine itself: progress of streaming queries as stored samples of back pressure.

The gauge is the time that a query works in a second of its trigger interval, in milliseconds (at most 1,000): a
query that is always busy cannot keep up, which holds back its source.
"""

from __future__ import annotations

import os
import threading
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from wakeline.operators.metrics import STEP_S
from wakeline.session import path_exists

METRIC = "backpressure_ms_per_s"
SAMPLE = "ts double, metric string, labels map<string,string>, value double"


class ProgressSamples(StreamingQueryListener):
    """Listener that keeps a sample per micro-batch until ``flush`` writes them to ``<root>/<table>``.

    The interval is the time from a query's trigger to its next one, so a sample is complete when the next
    micro-batch reports; the last one counts its own duration as the interval, but never less than ``trigger_s``. The listener
    holds a row a micro-batch since the last flush and the last progress of each running query.
    """

    def __init__(self, root: str, table: str = "stream_samples", trigger_s: float = 0.0):
        self.root, self.table, self.trigger_s = root, table, float(trigger_s)
        self._lock, self._last, self._rows = threading.Lock(), {}, []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        at = datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")).timestamp()
        busy = float(p.durationMs.get("triggerExecution", 0))
        with self._lock:
            self._close(str(p.runId), at)
            self._last[str(p.runId)] = (p.name or str(p.id), at, busy)

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._close(str(event.runId), None)

    def _close(self, run: str, next_at: float | None) -> None:
        if run not in self._last:
            return
        name, at, busy = self._last.pop(run)
        least = max(busy / 1000, self.trigger_s)
        interval = least if next_at is None else max(next_at - at, 0.001)
        value = min(1000.0, busy / interval) if interval else 0.0
        self._rows.append((at, METRIC, {"task": name}, value))

    def flush(self, spark: SparkSession) -> int:
        """Write the complete samples kept so far; their number. They are kept if the write fails."""
        with self._lock:
            rows = list(self._rows)
        if rows:
            spark.createDataFrame(rows, SAMPLE).coalesce(1).write.mode("append").parquet(os.path.join(self.root, self.table))
        with self._lock:
            del self._rows[:len(rows)]
        return len(rows)

    def samples(self, spark: SparkSession) -> DataFrame | None:
        """What was written, in the canonical form of stored samples."""
        path = os.path.join(self.root, self.table)
        return spark.read.parquet(path) if path_exists(spark, path) else None


def gauge(samples: DataFrame, start: float, step: float = STEP_S) -> DataFrame:
    """``task, k, value``: each query's last sample in the ``step`` seconds up to scrape ``k`` after ``start``, the form that the
    back-pressure alert reads. A scrape without a sample has no row."""
    rows = samples.filter((F.col("metric") == METRIC) & (F.col("ts") >= start))
    k = F.greatest(F.ceil((F.col("ts") - F.lit(float(start))) / F.lit(float(step))), F.lit(1)).cast("int")
    return rows.select(F.col("labels")["task"].alias("task"), k.alias("k"), "ts", "value").groupBy("task", "k").agg(
        F.max_by("value", "ts").alias("value"))
