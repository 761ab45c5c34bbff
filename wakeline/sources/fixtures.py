"""Input views derived from the given ``events`` table.

The driver's data has no position stream, so the position stream (``sensor``),
its raw JSON form (``raw_events``), the metric scrapes and the log lines are
derived from ``events`` with fixed formulas. Each formula is written once here
(Spark) and once in ``wakeline.plans.oracle`` (DuckDB); integer arithmetic
followed by one double division keeps both engines bit-equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture formulas.
EPOCH_2024_US = 1704067200000000     # 2024-01-01 00:00:00 UTC in microseconds
EPOCH_2024_S = 1704067200.0
TIME_COMPRESSION_US = 64800000000.0  # 30 days -> 40 s of event time
ARRIVAL_COMPRESSION_US = 648000000.0  # 30 days -> 4,000 s of arrival clock
X_BASE, X_MUL, X_MOD = 21.020602, 37, 22509
Y_BASE, Y_MUL, Y_MOD = 52.439085, 91, 17259
LATE_EVERY, LATE_AT, LATE_DELAY = 20, 13, 5.0
BAD_JSON_EVERY, MISSING_Y_EVERY = 97, 101
NOW = 1704067240.0                   # fixed processing clock for time_taken


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _micros_since_2024(ts: Column) -> Column:
    # Time-zone free: events.ts is TIMESTAMP_NTZ.
    return F.timestamp_diff("MICROSECOND", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), ts)


def _raw_x() -> Column:
    return F.lit(X_BASE) + ((F.col("event_id") * X_MUL) % X_MOD) / F.lit(1000000.0)


def _raw_y() -> Column:
    return F.lit(Y_BASE) + ((F.col("event_id") * Y_MUL) % Y_MOD) / F.lit(1000000.0)


def _event_time() -> Column:
    base = F.lit(EPOCH_2024_S) + _micros_since_2024(F.col("ts")) / F.lit(TIME_COMPRESSION_US)
    delay = F.when(F.col("event_id") % LATE_EVERY == LATE_AT, F.lit(LATE_DELAY)).otherwise(F.lit(0.0))
    return base - delay


def _arrival() -> Column:
    return F.lit(EPOCH_2024_S) + _micros_since_2024(F.col("ts")) / F.lit(ARRIVAL_COMPRESSION_US)


def sensor(events: DataFrame) -> DataFrame:
    """Position stream: ``seq, id, x FLOAT, y FLOAT, timestamp, arrival``."""
    return events.select(
        F.col("event_id").alias("seq"),
        F.col("user_id").cast("int").alias("id"),
        _raw_x().cast("float").alias("x"),
        _raw_y().cast("float").alias("y"),
        _event_time().alias("timestamp"),
        _arrival().alias("arrival"),
    )


def raw_events(events: DataFrame) -> DataFrame:
    """Raw JSON text per event (``seq, value``), with broken and incomplete records."""
    full = F.to_json(F.struct(F.col("user_id").alias("id"), _raw_x().alias("x"),
                              _raw_y().alias("y"), _event_time().alias("timestamp")))
    no_y = F.to_json(F.struct(F.col("user_id").alias("id"), _raw_x().alias("x"),
                              _event_time().alias("timestamp")))
    value = (F.when(F.col("event_id") % BAD_JSON_EVERY == 0, F.lit("not json"))
             .when(F.col("event_id") % MISSING_Y_EVERY == 0, no_y)
             .otherwise(full))
    return events.select(F.col("event_id").alias("seq"), value.alias("value"))


def load_sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensor(read_table(spark, sf_dir, "events"))


def load_raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_events(read_table(spark, sf_dir, "events"))
