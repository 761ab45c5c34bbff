"""Time the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; print one JSON line.

Each query is executed in full with the no-op sink (no driver collect).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "inst_speed",
    "on_time_events",
    "parse_events",
    "inst_speed_stateful",
    "on_time_by_device",
    "readings_append",
    "latest_per_device",
    "archive_batches",
    "late_ratio",
    "cpu_usage",
    "alert_late_events_all",
    "error_logs",
    "device_counters_long",
    "alert_low_output",
    "instant_values",
    "stat_panels",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from wakeline.session import local_session
    from wakeline.plans.queries import QUERIES

    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="wakeline-bench")
    spark.sparkContext.setLogLevel("OFF")
    # Warm-up: JVM code paths and the Python worker pool, on tiny inputs.
    QUERIES["on_time_total"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.range(64).mapInPandas(lambda it: it, "id long").write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
