"""stream/batch sources and sinks for raw and enriched events.

No Kafka, JDBC or object-store jars ship with a plain PySpark install, so every
function takes a ``fmt`` and options: ``kafka`` on a cluster that has the
connector, files (``parquet``/``json``/``text``) everywhere else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline.schemas import RAW_EVENT
from wakeline.session import path_exists

RAW_TABLE = T.StructType([T.StructField("seq", T.LongType()), T.StructField("value", T.StringType())])


def arrival_seq(partition: Column, offset: Column, partitions: int = 1) -> Column:
    """One order over the records of ``partitions`` source partitions: by offset, then by partition.

    The numbers are unique and keep each partition's order; with one partition they are its offsets.
    A partition number outside ``0..partitions-1`` would collide with another and is an error.
    """
    packed = offset.cast("long") * F.lit(int(partitions)) + partition.cast("long")
    known = (partition >= 0) & (partition < F.lit(int(partitions)))
    return F.when(known, packed).otherwise(
        F.raise_error(F.concat(F.lit("unknown source partition "), partition.cast("string"))).cast("long"))


def read_raw_stream(spark: SparkSession, fmt: str = "kafka", path: str | None = None,
                    starting: str = "latest", options: dict | None = None, partitions: int = 1) -> DataFrame:
    """Raw topic as a stream of ``seq, value`` (value = UTF-8 text of one JSON object).

    Kafka: ``seq`` is ``arrival_seq`` of the record, and ``partition`` and ``offset`` follow. ``partitions``
    is the topic's number of partitions; it must not change while a checkpoint lives. Across
    micro-batches the order of the batches comes first. Files: rows of ``seq, value`` (parquet/json) or
    lines (text).
    """
    opts = dict(options or {})
    if fmt == "kafka":
        df = (spark.readStream.format("kafka").option("startingOffsets", starting).options(**opts).load())
        return df.select(arrival_seq(F.col("partition"), F.col("offset"), partitions).alias("seq"),
                         F.col("value").cast("string").alias("value"), "partition", "offset")
    reader = spark.readStream.format(fmt).options(**opts)
    if fmt in ("parquet", "json", "orc"):
        reader = reader.schema(RAW_TABLE)
    return reader.load(path)


def read_enriched_stream(spark: SparkSession, fmt: str = "kafka", path: str | None = None,
                         starting: str = "earliest", options: dict | None = None, partitions: int = 1) -> DataFrame:
    """S3: the enriched topic, decoded with the declared six-field schema (keeps ``seq``)."""
    from wakeline.functions.jsonfmt import from_json_value

    return from_json_value(read_raw_stream(spark, fmt, path, starting, options, partitions), keep=["seq"])


def write_stream(df: DataFrame, fmt: str, checkpoint: str, path: str | None = None,
                 options: dict | None = None, trigger: dict | None = None, mode: str = "append"):
    """Start a checkpointed streaming write (file sinks are exactly-once, Kafka at-least-once)."""
    w = df.writeStream.format(fmt).option("checkpointLocation", checkpoint).outputMode(mode)
    w = w.options(**(options or {}))
    if trigger:
        w = w.trigger(**trigger)
    return w.start(path) if path else w.start()


def enriched_to_topic(df: DataFrame) -> DataFrame:
    """K1: ``value`` = JSON of the six enriched fields (key unused, as in the reference)."""
    return df.select(F.to_json(F.struct("id", "x", "y", "timestamp", "inst_speed", "time_taken")).alias("value"))


ARCHIVE_RANGE = 10_000
TAIL = "_tail"


def archive_lines(archive: DataFrame) -> DataFrame:
    """``batch_no, value`` with one JSON object a batch: its number and its records as they came."""
    line = F.concat(F.lit('{"batch_no":'), F.col("batch_no").cast("string"), F.lit(',"records":'), F.col("value"), F.lit("}"))
    return archive.select("batch_no", line.alias("value"))


def write_archive(archive: DataFrame, path: str, mode: str = "append", batches: int = ARCHIVE_RANGE) -> None:
    """K4: write archive batches (``batch_no, value``), a line each, in one folder per ``batches`` batches."""
    folder = F.floor(F.col("batch_no") / F.lit(batches)).cast("long").alias("batch_range")
    archive_lines(archive).select(folder, "value").write.mode(mode).partitionBy("batch_range").text(path)


def replay_archive(spark: SparkSession, path: str) -> DataFrame:
    """Read the archive back, one row per archived raw record, with its ``batch_no``.

    A flushed last batch (in ``path + "_tail"``) counts until the archive holds a batch of its number.
    """
    schema = T.StructType([T.StructField("batch_no", T.LongType()), T.StructField("records", T.ArrayType(RAW_EVENT))])
    read = lambda folder: spark.read.schema(schema).json(folder).select("batch_no", "records")
    if path_exists(spark, path + TAIL):
        tail = read(path + TAIL)
        rows = tail if not path_exists(spark, path) else read(path).unionByName(
            tail.join(read(path).select("batch_no"), "batch_no", "left_anti"))
    else:
        rows = read(path)
    return rows.select("batch_no", F.posexplode("records").alias("pos", "_e")).select("batch_no", "pos", "_e.*")


def write_readings(readings: DataFrame, fmt: str = "parquet", path: str | None = None,
                   options: dict | None = None) -> None:
    """K8: append readings rows; ``fmt='jdbc'`` uses batch size 20 unless given."""
    if fmt == "jdbc":
        opts = {"batchsize": "20", **(options or {})}
        readings.write.format("jdbc").options(**opts).mode("append").save()
    else:
        readings.write.format(fmt).options(**(options or {})).mode("append").save(path)
