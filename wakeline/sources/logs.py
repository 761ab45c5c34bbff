"""Log line sources (files by glob, container streams) and the log fixture.

Lines look like ``YYYY-mm-dd HH:MM:SS [LEVEL] logger - message``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the log fixture.
SERVICES = ["stream_job", "archive_sink", "table_sink", "live_feed", "producer"]


def read_log_files(spark: SparkSession, glob: str) -> DataFrame:
    """``file_path, value``: one row per line of every file matching ``glob``."""
    return spark.read.text(glob).select(F.col("_metadata.file_path").alias("file_path"), "value")


def read_log_files_stream(spark: SparkSession, directory: str) -> DataFrame:
    return spark.readStream.format("text").load(directory).select(
        F.col("_metadata.file_path").alias("file_path"), "value")


def read_container_logs(spark: SparkSession, glob: str) -> DataFrame:
    """``container, value`` from JSON lines with the fields ``container`` (its name) and ``line``."""
    return spark.read.schema("container string, line string").json(glob).select(
        "container", F.col("line").alias("value"))


def _service():
    svc = F.array(*[F.lit(s) for s in SERVICES])
    return F.element_at(svc, (F.col("user_id") % len(SERVICES) + 1).cast("int"))


def _line():
    level = F.when(F.col("event_type") == "error", F.lit("ERROR")).otherwise(F.lit("INFO"))
    return F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" ["), level, F.lit("] "), _service(),
                    F.lit(" - event "), F.col("event_id").cast("string"), F.lit(" "), F.col("event_type"),
                    F.lit(" props="), F.col("props"))


def file_logs(events: DataFrame) -> DataFrame:
    """Fixture ``logs(file_path, value)``: the even events, as lines of per-service files."""
    return events.filter(F.col("event_id") % 2 == 0).select(
        F.concat(F.lit("/logs/"), _service(), F.lit("/"), _service(), F.lit(".log")).alias("file_path"),
        _line().alias("value"))


def container_logs(events: DataFrame) -> DataFrame:
    """Fixture container stream ``(container, value)``: the odd events."""
    return events.filter(F.col("event_id") % 2 == 1).select(
        F.concat(F.lit("/"), _service()).alias("container"), _line().alias("value"))
