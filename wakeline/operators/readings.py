"""Shape enriched rows for the relational ``readings`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.functions.geo import epoch_to_timestamp
from wakeline.operators.prefix import DEFAULT_BUCKET_ROWS, DEFAULT_LEVELS, global_row_number

NOT_NULL = ["device_id", "x", "y", "timestamp", "inst_speed", "time_taken"]


def to_readings(enriched: DataFrame, seq: str = "seq", first_id: int = 1,
                bucket_rows: int = DEFAULT_BUCKET_ROWS, levels: int = DEFAULT_LEVELS) -> DataFrame:
    """Rename and retype: ``id -> device_id``, epoch -> TIMESTAMP, float -> double.

    ``reading_id`` is a dense serial in arrival order starting at ``first_id``
    (pass the table's next id when appending). Rows with a NULL in any
    NOT NULL column take no id; ``rejected_readings`` returns them with the reason.
    """
    d = global_row_number(enriched.filter(_violation().isNull()), seq, "_rn", bucket_rows=bucket_rows,
                          levels=levels)
    return d.select(
        (F.col("_rn") + F.lit(first_id - 1)).alias("reading_id"),
        F.col("id").cast("int").alias("device_id"),
        F.col("x").cast("double").alias("x"),
        F.col("y").cast("double").alias("y"),
        epoch_to_timestamp(F.col("timestamp")).alias("timestamp"),
        F.col("inst_speed").cast("double").alias("inst_speed"),
        F.col("time_taken").cast("double").alias("time_taken"),
    )


def _violation():
    """The NOT NULL columns that are NULL, comma-joined; NULL for a valid row."""
    names = [F.when(F.col("id" if c == "device_id" else c).isNull(), c) for c in NOT_NULL]
    text = F.concat_ws(",", *names)
    return F.when(text != "", text)


def rejected_readings(enriched: DataFrame) -> DataFrame:
    """Rows that the ``readings`` table refuses, with ``reason``: the NOT NULL columns that are NULL."""
    return enriched.withColumn("reason", _violation()).filter(F.col("reason").isNotNull())
