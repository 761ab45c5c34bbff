"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator group.

Each reads the driver's tables (through the fixture views derived from
``events``) and runs over the whole table. Column names match
``wakeline.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.functions import jsonfmt
from wakeline.operators import batches, counters, lateness, latest, parse, prefix, readings, speed
from wakeline.operators import logs as lg
from wakeline.operators.prefix import global_row_number
from wakeline.session import materialize
from wakeline.sources import fixtures as fx
from wakeline.sources import io
from wakeline.sources import logs as lsrc

Query = Callable[[SparkSession, str], DataFrame]


def _xy(df: DataFrame) -> DataFrame:
    """Present float32 coordinates as doubles (exact widening)."""
    return df.withColumn("x", F.col("x").cast("double")).withColumn("y", F.col("y").cast("double"))


def _classified(spark: SparkSession, sf_dir: str, scope: str = "stream") -> DataFrame:
    return lateness.classify_lateness(fx.load_sensor(spark, sf_dir), scope=scope)


def _on_time(spark, sf_dir) -> DataFrame:
    return _classified(spark, sf_dir).filter(~F.col("is_late")).drop("is_late")


def _late(spark, sf_dir) -> DataFrame:
    return _classified(spark, sf_dir).filter(F.col("is_late")).drop("is_late")


PARTITIONS = 3
CLOCK_START = 1 << 60
EVENT_COLS = ["seq", "id", "x", "y", "timestamp"]


def q_parse_events(spark, sf_dir):
    return _xy(parse.parse_events(fx.load_raw_events(spark, sf_dir)).select(*EVENT_COLS))


def q_quarantine_events(spark, sf_dir):
    return parse.quarantine(fx.load_raw_events(spark, sf_dir)).select("seq", "reason")


def q_on_time_events(spark, sf_dir):
    return _xy(_on_time(spark, sf_dir).select(*EVENT_COLS))


def q_late_events(spark, sf_dir):
    return _xy(_late(spark, sf_dir).select(*EVENT_COLS))


def q_lateness_by_device_scope(spark, sf_dir):
    return _xy(_classified(spark, sf_dir, scope="device").select(*EVENT_COLS, "is_late"))


def q_multi_partition_lateness(spark, sf_dir):
    """W0 over three source partitions, each with its own offsets from 0 (devices are spread by id)."""
    s = fx.load_sensor(spark, sf_dir).withColumn("partition", F.col("id") % PARTITIONS)
    s = global_row_number(s, "seq", "_rn", keys=["partition"]).withColumn("offset", F.col("_rn") - 1)
    s = s.withColumn("seq", io.arrival_seq(F.col("partition"), F.col("offset"), PARTITIONS))
    return lateness.classify_lateness(s).select("partition", "offset", "seq", "id", "timestamp", "is_late")


def q_clock_order_lateness(spark, sf_dir):
    """W0 and exact batches over arrival numbers in clumps that lie far apart, as clocks and packed offsets give."""
    s = fx.load_sensor(spark, sf_dir)
    far = F.shiftleft(F.expr("seq div 1000"), 40) + (F.col("seq") % 1000) * F.lit(1009)
    s = s.withColumn("seq", far + F.lit(CLOCK_START))
    cut = prefix.measured_buckets(s, "seq", bucket_rows=5000)
    rows = lateness.classify_lateness(s, bucket_rows=cut)
    return batches.assign_batches(rows, batches.ARCHIVE_BATCH, bucket_rows=cut).select("seq", "id", "timestamp", "is_late", "batch_no")


def q_inst_speed(spark, sf_dir):
    return _xy(speed.inst_speed(_on_time(spark, sf_dir)))


def q_inst_speed_stateful(spark, sf_dir):
    return _xy(speed.inst_speed_stateful(_on_time(spark, sf_dir)))


def q_speed_suppressed(spark, sf_dir):
    return speed.speed_suppressed(_on_time(spark, sf_dir))


def _enriched(spark, sf_dir) -> DataFrame:
    """What the job emits: the coded speed rule plus latency at the fixed clock."""
    e = speed.inst_speed_stateful(_on_time(spark, sf_dir))
    e = e.withColumn("inst_speed", F.col("inst_speed").cast("float"))
    return speed.with_time_taken(e, now=fx.NOW)


def q_time_taken(spark, sf_dir):
    return _enriched(spark, sf_dir).select("seq", "id", F.col("time_taken").cast("double"))


def q_on_time_by_device(spark, sf_dir):
    return counters.count_by_device(_on_time(spark, sf_dir))


def q_on_time_total(spark, sf_dir):
    return counters.count_total(_on_time(spark, sf_dir))


def q_late_by_device(spark, sf_dir):
    return counters.count_by_device(_late(spark, sf_dir))


def q_late_total(spark, sf_dir):
    return counters.count_total(_late(spark, sf_dir))


def q_time_counter_ms(spark, sf_dir):
    return counters.time_counter_ms(_enriched(spark, sf_dir)).select(F.round("ms", 2).alias("ms"))


def q_device_counters_long(spark, sf_dir):
    d = counters.device_counters_long(_classified(spark, sf_dir), _enriched(spark, sf_dir))
    return d.withColumn("value", F.round("value", 2))


def _valid_raw(spark, sf_dir) -> DataFrame:
    """Raw records any JSON decoder accepts (what the archive consumer can read)."""
    raw = fx.load_raw_events(spark, sf_dir)
    return raw.filter(F.try_parse_json("value").isNotNull())


def q_raw_json(spark, sf_dir):
    s = fx.load_sensor(spark, sf_dir)
    j = jsonfmt.to_json_value(s, jsonfmt.RAW_FIELDS, keep=["seq"])
    return _xy(jsonfmt.from_json_value(j, jsonfmt.RAW_DECLARED, keep=["seq"]))


def q_enriched_json(spark, sf_dir):
    j = jsonfmt.to_json_value(_enriched(spark, sf_dir), keep=["seq"])
    back = jsonfmt.from_json_value(j, keep=["seq"])
    return _xy(back).select("seq", "id", "x", "y", "timestamp",
                            F.col("inst_speed").cast("double"), F.col("time_taken").cast("double"))


def q_archive_batches(spark, sf_dir):
    return batches.batch_summary(batches.assign_batches(_valid_raw(spark, sf_dir), batches.ARCHIVE_BATCH))


def q_archive_replay(spark, sf_dir):
    arch = batches.archive_records(_valid_raw(spark, sf_dir), batches.ARCHIVE_BATCH)
    return batches.replay_archive_text(arch)


def q_readings_batches(spark, sf_dir):
    e = materialize(_enriched(spark, sf_dir))
    return batches.batch_summary(batches.assign_batches(e, batches.READINGS_BATCH))


def q_rejected_readings(spark, sf_dir):
    """On-time events that have no speed cannot be readings: their NOT NULL columns are empty."""
    e = _enriched(spark, sf_dir).select("seq", "inst_speed", "time_taken")
    rows = _on_time(spark, sf_dir).select("seq", "id", "x", "y", "timestamp").join(e, "seq", "left")
    return readings.rejected_readings(rows).select("seq", "id", "reason")


def q_readings_append(spark, sf_dir):
    r = readings.to_readings(materialize(_enriched(spark, sf_dir)))
    return r.select("reading_id", "device_id", "x", "y", F.unix_micros("timestamp").alias("ts_us"),
                    "inst_speed", "time_taken")


def q_latest_per_device(spark, sf_dir):
    return latest.latest_per_device(_enriched(spark, sf_dir))


def q_speed_board(spark, sf_dir):
    return latest.speed_board(spark, latest.latest_per_device(_enriched(spark, sf_dir)))


def _logs(spark, sf_dir) -> DataFrame:
    ev = fx.read_table(spark, sf_dir, "events")
    return lg.labelled_logs(lsrc.file_logs(ev), lsrc.container_logs(ev))


def q_parse_logs(spark, sf_dir):
    return _logs(spark, sf_dir).select(*lg.PARSED_COLUMNS)


def q_service_labels(spark, sf_dir):
    return _logs(spark, sf_dir).select("source", "service_name").distinct()


def q_error_logs(spark, sf_dir):
    return lg.error_logs(_logs(spark, sf_dir)).select(*lg.PARSED_COLUMNS)


from wakeline.plans.metric_queries import METRIC_QUERIES  # noqa: E402
from wakeline.plans.stream_queries import STREAM_QUERIES  # noqa: E402

QUERIES: dict[str, Query] = {
    "parse_events": q_parse_events,
    "quarantine_events": q_quarantine_events,
    "on_time_events": q_on_time_events,
    "late_events": q_late_events,
    "lateness_by_device_scope": q_lateness_by_device_scope,
    "multi_partition_lateness": q_multi_partition_lateness,
    "clock_order_lateness": q_clock_order_lateness,
    "inst_speed": q_inst_speed,
    "inst_speed_stateful": q_inst_speed_stateful,
    "speed_suppressed": q_speed_suppressed,
    "time_taken": q_time_taken,
    "on_time_by_device": q_on_time_by_device,
    "on_time_total": q_on_time_total,
    "late_by_device": q_late_by_device,
    "late_total": q_late_total,
    "time_counter_ms": q_time_counter_ms,
    "device_counters_long": q_device_counters_long,
    "raw_json": q_raw_json,
    "enriched_json": q_enriched_json,
    "archive_batches": q_archive_batches,
    "archive_replay": q_archive_replay,
    "readings_batches": q_readings_batches,
    "readings_append": q_readings_append,
    "rejected_readings": q_rejected_readings,
    "latest_per_device": q_latest_per_device,
    "speed_board": q_speed_board,
    **METRIC_QUERIES,
    **STREAM_QUERIES,
    "parse_logs": q_parse_logs,
    "service_labels": q_service_labels,
    "error_logs": q_error_logs,
}
