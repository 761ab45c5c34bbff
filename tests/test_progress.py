"""M8: back pressure of running streams, sampled from their progress."""

import os
import time
from types import SimpleNamespace

from wakeline.operators import alerts
from wakeline.streaming.progress import METRIC, ProgressSamples, gauge


def _progress(run, second, busy_ms):
    return SimpleNamespace(progress=SimpleNamespace(runId=run, id="i", name=f"q{run}", durationMs={"triggerExecution": busy_ms},
                                                    timestamp=f"2024-01-01T00:{second // 60:02d}:{second % 60:02d}.000Z"))


def test_samples_of_a_running_stream(spark, scratch):
    src = os.path.join(scratch, "src")
    for i in range(3):
        spark.range(i * 5, i * 5 + 5).coalesce(1).write.mode("append").parquet(src)
    listener = ProgressSamples(scratch)
    spark.streams.addListener(listener)
    try:
        stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(src)
        q = (stream.writeStream.queryName("busy").format("noop").option("checkpointLocation", os.path.join(scratch, "ck"))
             .trigger(availableNow=True).start())
        q.awaitTermination(120)
        written, end = 0, time.time() + 30
        while written < 3 and time.time() < end:
            time.sleep(0.2)
            written += listener.flush(spark)
    finally:
        spark.streams.removeListener(listener)
    rows = listener.samples(spark).collect()
    assert len(rows) >= 3 and {(r.metric, r.labels["task"]) for r in rows} == {(METRIC, "busy")}
    assert all(0 < r.value <= 1000 for r in rows)


def test_gauge_feeds_the_alert(spark, scratch):
    """A query busy for nine of ten seconds fires after its hold time, one busy for a second does not."""
    listener = ProgressSamples(scratch, trigger_s=10)
    for s in range(0, 300, 10):
        listener.onQueryProgress(_progress("a", s, 9000))
        listener.onQueryProgress(_progress("b", s, 1000))
    for run in "ab":
        listener.onQueryTerminated(SimpleNamespace(runId=run))
    assert listener.flush(spark) == 60 and listener.flush(spark) == 0
    values = gauge(listener.samples(spark), 1704067200.0).withColumnRenamed("task", "series")
    assert {(r.series, r.value) for r in values.collect()} == {("qa", 900.0), ("qb", 100.0)}
    grid = values.select("series", "k").distinct().filter("k % 4 = 0")
    states = {}
    for r in alerts.alert_states(values, grid, ["series"], "gt", 500.0, 60.0, 15.0).orderBy("k").collect():
        states.setdefault(r.series, []).append(r.state)
    assert states["qa"][-1] == "firing" and "firing" not in states["qb"]
