"""Declared record types (explicit, never inferred)."""

from pyspark.sql import types as T

# Raw event as the producer writes it: all numbers are JSON numbers.
RAW_EVENT = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("x", T.DoubleType()),
    T.StructField("y", T.DoubleType()),
    T.StructField("timestamp", T.DoubleType()),
])

# Parsed event at operator boundaries: coordinates narrowed to float32.
PARSED_COLUMNS = ["id", "x", "y", "timestamp"]

# Enriched event (what the speed stage emits and the sinks consume).
ENRICHED = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("x", T.FloatType()),
    T.StructField("y", T.FloatType()),
    T.StructField("timestamp", T.DoubleType()),
    T.StructField("inst_speed", T.FloatType()),
    T.StructField("time_taken", T.FloatType()),
])

# Relational sink row.
READINGS = T.StructType([
    T.StructField("reading_id", T.LongType(), False),
    T.StructField("device_id", T.IntegerType(), False),
    T.StructField("x", T.DoubleType(), False),
    T.StructField("y", T.DoubleType(), False),
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("inst_speed", T.DoubleType(), False),
    T.StructField("time_taken", T.DoubleType(), False),
])

# Metric sample (one value of one series at one scrape time).
METRIC_SAMPLE = T.StructType([
    T.StructField("ts", T.DoubleType()),
    T.StructField("metric", T.StringType()),
    T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
    T.StructField("value", T.DoubleType()),
])
