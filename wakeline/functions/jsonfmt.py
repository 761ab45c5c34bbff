"""JSON row serialisation of raw and enriched events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline.schemas import ENRICHED

RAW_FIELDS = ["id", "x", "y", "timestamp"]
ENRICHED_FIELDS = [f.name for f in ENRICHED.fields]

RAW_DECLARED = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("x", T.FloatType()),
    T.StructField("y", T.FloatType()),
    T.StructField("timestamp", T.DoubleType()),
])


def to_json_value(df: DataFrame, fields=ENRICHED_FIELDS, keep=()) -> DataFrame:
    """``value`` = JSON object of the named fields (what goes to a topic)."""
    return df.select(*keep, F.to_json(F.struct(*fields)).alias("value"))


def from_json_value(df: DataFrame, schema: T.StructType = ENRICHED, value: str = "value", keep=()) -> DataFrame:
    return df.select(*keep, F.from_json(F.col(value), schema).alias("_v")).select(*keep, "_v.*")
