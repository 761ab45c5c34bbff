"""Fixed-size batches in arrival order, the JSON-array archive and its replay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline.operators.prefix import DEFAULT_BUCKET_ROWS, DEFAULT_LEVELS, Buckets, global_row_number
from wakeline.schemas import RAW_EVENT

ARCHIVE_BATCH = 200
READINGS_BATCH = 20


def assign_batches(df: DataFrame, n: int, seq: str = "seq", out: str = "batch_no",
                   bucket_rows: int | Buckets = DEFAULT_BUCKET_ROWS, levels: int = DEFAULT_LEVELS) -> DataFrame:
    """Add ``batch_no`` = floor((position in ``seq`` order - 1) / n).

    Every batch holds exactly ``n`` rows except possibly the last, which is
    kept (the reference loses it on stop; we flush it).
    """
    if n <= 0:
        raise ValueError("batch size must be positive")
    d = global_row_number(df, seq, "_rn", bucket_rows=bucket_rows, levels=levels)
    return d.withColumn(out, F.floor((F.col("_rn") - 1) / F.lit(n)).cast("long")).drop("_rn")


def batch_summary(batched: DataFrame, seq: str = "seq", batch: str = "batch_no") -> DataFrame:
    return batched.groupBy(batch).agg(F.count(F.lit(1)).alias("n"),
                                      F.min(seq).alias("first_seq"), F.max(seq).alias("last_seq"))


def archive_records(raw: DataFrame, n: int = ARCHIVE_BATCH, value: str = "value",
                    seq: str = "seq") -> DataFrame:
    """One row per batch: ``batch_no, value`` where value is the JSON array of the batch.

    Each record's JSON object text is embedded as is (no re-serialisation), in
    arrival order. A batch is bounded by ``n`` rows, so the per-batch
    ``collect_list`` is bounded too.
    """
    b = assign_batches(raw.select(seq, value), n, seq)
    arr = F.array_sort(F.collect_list(F.struct(F.col(seq).alias("s"), F.col(value).alias("v"))))
    return (b.groupBy("batch_no").agg(arr.alias("_items"))
            .select("batch_no",
                    F.concat(F.lit("["), F.array_join(F.transform("_items", lambda e: e["v"]), ","),
                             F.lit("]")).alias("value")))


def replay_archive_text(archive: DataFrame, value: str = "value",
                        schema: T.StructType = RAW_EVENT) -> DataFrame:
    """Parse archive text (one JSON array per row) back into one row per element."""
    arr = F.from_json(F.col(value), T.ArrayType(schema))
    return archive.select(F.explode(arr).alias("_e")).select("_e.*")


# Fixed value: archive object names as the reference formats them (%Y%m%d_%H%M%S_%f).
ARCHIVE_NAME_FORMAT = "yyyyMMdd_HHmmss_SSSSSS"


def archive_object_name(ts, prefix: str = "raw_data/", suffix: str = ".json"):
    """``raw_data/<yyyyMMdd_HHmmss_ffffff>.json`` for a batch time column (e.g. its first arrival)."""
    return F.concat(F.lit(prefix), F.date_format(ts, ARCHIVE_NAME_FORMAT), F.lit(suffix))
