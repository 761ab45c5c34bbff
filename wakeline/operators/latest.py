"""The latest record per device and the six-slot speed board."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.functions.geo import to_fixed_1

# Fixed values of the board: six slots, start positions before any message.
BOARD_IDS = (1, 2, 3, 4, 5, 6)
START_LAT = 52.448922
START_LAT_STEP = 1000.0
START_LON = 21.031619
DEFAULT_SPEED_TEXT = "0.0"


def latest_per_device(df: DataFrame, key: str = "id", order: str = "seq") -> DataFrame:
    """Last row per device in arrival order, as ``id, lat, lon, inst_speed``.

    ``max_by`` is a plain aggregate: map-side partial aggregation keeps one
    candidate per device per task, so a hot device costs nothing extra.
    """
    last = F.max_by(F.struct("x", "y", "inst_speed"), F.col(order))
    return (df.filter(F.col("inst_speed").isNotNull())
            .groupBy(key).agg(last.alias("_l"))
            .select(key, F.col("_l.y").cast("double").alias("lat"), F.col("_l.x").cast("double").alias("lon"),
                    F.col("_l.inst_speed").cast("double").alias("inst_speed")))


def speed_board(spark: SparkSession, latest: DataFrame, ids=BOARD_IDS, key: str = "id") -> DataFrame:
    """One row per board slot: latest speed as one-decimal text and position, or the defaults.

    Unknown ids are ignored; the slot list is a small fixed parameter, so the
    join to it is a broadcast of a bounded table.
    """
    slots = spark.createDataFrame([(int(i),) for i in ids], f"{key} int")
    known = latest.join(F.broadcast(slots), key, "inner")
    j = slots.join(known, key, "left")
    default_lat = F.lit(START_LAT) - (F.col(key) - 1).cast("double") / F.lit(START_LAT_STEP)
    return j.select(
        key,
        F.coalesce(to_fixed_1(F.col("inst_speed")), F.lit(DEFAULT_SPEED_TEXT)).alias("speed_text"),
        F.coalesce(F.col("lat"), default_lat).alias("lat"),
        F.coalesce(F.col("lon"), F.lit(START_LON)).alias("lon"),
    )
