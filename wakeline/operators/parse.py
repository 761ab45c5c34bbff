"""Parse raw JSON text into typed events; route bad records to quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline.schemas import RAW_EVENT

CORRUPT = "_corrupt_record"
_PARSE_SCHEMA = T.StructType(RAW_EVENT.fields + [T.StructField(CORRUPT, T.StringType())])
_INT_MIN, _INT_MAX = -(2 ** 31), 2 ** 31 - 1


def parse_with_reason(raw: DataFrame, value: str = "value") -> DataFrame:
    """Parse ``value`` (JSON object text); add ``reason`` (NULL when the record is good).

    ``malformed``: not a JSON object, or a field of the wrong JSON type.
    ``missing_field``: one of id, x, y, timestamp absent or null.
    ``out_of_range``: id does not fit a 32-bit integer.
    Extra fields are ignored (the parser projects to the four declared ones).
    """
    j = F.from_json(F.col(value), _PARSE_SCHEMA,
                    {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    d = raw.withColumn("_j", j)
    missing = (F.col("_j.id").isNull() | F.col("_j.x").isNull()
               | F.col("_j.y").isNull() | F.col("_j.timestamp").isNull())
    reason = (F.when(F.col("_j").isNull() | F.col(f"_j.{CORRUPT}").isNotNull(), F.lit("malformed"))
              .when(missing, F.lit("missing_field"))
              .when(~F.col("_j.id").between(_INT_MIN, _INT_MAX), F.lit("out_of_range")))
    return d.withColumn("reason", reason)


def parse_events(raw: DataFrame, value: str = "value", on_bad: str = "quarantine") -> DataFrame:
    """Good records as ``<other columns>, id INT, x FLOAT, y FLOAT, timestamp DOUBLE``.

    ``on_bad="fail"`` raises on the first incomplete record instead of routing it
    away (the reference's job dies on such a record).
    """
    d = parse_with_reason(raw, value)
    keep = [c for c in raw.columns if c != value]
    if on_bad == "fail":
        d = d.withColumn("_chk", F.when(F.col("reason").isin("missing_field", "out_of_range"),
                                        F.raise_error(F.concat(F.lit("bad record: "), F.col(value)))))
        d = d.filter(F.col("_chk").isNull() & F.col("reason").isNull())
    else:
        d = d.filter(F.col("reason").isNull())
    return d.select(*keep,
                    F.col("_j.id").cast("int").alias("id"),
                    F.col("_j.x").cast("float").alias("x"),
                    F.col("_j.y").cast("float").alias("y"),
                    F.col("_j.timestamp").alias("timestamp"))


def quarantine(raw: DataFrame, value: str = "value") -> DataFrame:
    """Bad records with their text and ``reason``."""
    d = parse_with_reason(raw, value)
    return d.filter(F.col("reason").isNotNull()).drop("_j")
