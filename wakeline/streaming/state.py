"""Small per-micro-batch state tables kept in a shared folder.

Each micro-batch ``b`` writes its outputs and its carry-out under
``.../batch_id=b`` once, and reads its carry-in from the newest batch before
``b``. A replayed batch therefore reads the same carry and leaves what is
written as it is, and a restart resumes where the last committed batch
stopped. The folder belongs to one set of stream checkpoints.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.session import path_exists


def write_batch(df: DataFrame, root: str, table: str, batch_id: int, fmt: str = "parquet") -> None:
    """Write the rows of ``table`` for ``batch_id``, once.

    A batch's folder appears as a whole when its write commits. A replayed batch has the same rows, so
    a folder that is there is left alone: streams that read the table as files never see the rows
    again under new file names.
    """
    if path_exists(df.sparkSession, os.path.join(root, table, f"batch_id={int(batch_id)}")):
        return
    (df.withColumn("batch_id", F.lit(int(batch_id)))
     .write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").save(os.path.join(root, table)))


def read_table(spark: SparkSession, root: str, table: str, fmt: str = "parquet") -> DataFrame | None:
    path = os.path.join(root, table)
    if not path_exists(spark, path):
        return None
    return spark.read.format(fmt).load(path)


def _folder(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def batch_ids(spark: SparkSession, root: str, table: str) -> list[int]:
    """Ids of the batches that wrote ``table``, ascending: names of folders, no file is read."""
    fs, path = _folder(spark, os.path.join(root, table))
    if not fs.exists(path):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(path)]
    return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith("batch_id="))


def batch_before(spark: SparkSession, root: str, table: str, batch_id: int) -> int | None:
    """Id of the newest batch before ``batch_id`` that wrote ``table`` (None if none).

    Usually that is ``batch_id - 1``, checked directly; after a gap the folder's names are searched.
    """
    if batch_id > 0 and path_exists(spark, os.path.join(root, table, f"batch_id={int(batch_id) - 1}")):
        return int(batch_id) - 1
    return max((b for b in batch_ids(spark, root, table) if b < batch_id), default=None)


def forget(spark: SparkSession, root: str, table: str, before: int) -> None:
    """Delete what batches before ``before`` wrote: state that a later batch has taken over.

    Only a stream's newest batch can be replayed, and it reads the state of the one before it, so a caller keeps
    these two.
    """
    for b in batch_ids(spark, root, table):
        if b < before:
            fs, path = _folder(spark, os.path.join(root, table, f"batch_id={b}"))
            fs.delete(path, True)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the stream's own that a later batch has taken over; nothing if it is not there."""
    fs, at = _folder(spark, path)
    fs.delete(at, True)


def read_partition(spark: SparkSession, root: str, table: str, batch_id: int) -> DataFrame | None:
    """Rows ``table`` holds for exactly ``batch_id`` (None when it wrote none)."""
    path = os.path.join(root, table, f"batch_id={int(batch_id)}")
    return spark.read.parquet(path) if path_exists(spark, path) else None


def carry_before(spark: SparkSession, root: str, table: str, batch_id: int) -> DataFrame | None:
    """Rows of ``table`` written by the newest batch before ``batch_id`` (None if there is none).

    Only for tables every batch writes at least one row to (carries, counters):
    an empty write leaves no partition behind.
    """
    prev = batch_before(spark, root, table, batch_id)
    return None if prev is None else read_partition(spark, root, table, prev)


SNAPSHOT = "_snapshot"


class Folded:
    """A keyed table that micro-batches change: changes per batch, now and then folded into a snapshot.

    ``fold`` turns any union of rows of the table into one row per key and must not care in which batches the rows
    came, so a replayed batch changes nothing. Every ``every``-th batch writes a snapshot; changes and snapshots older than the
    snapshot before it are deleted (unless ``keep``), so the number of folders stays bounded.
    """

    def __init__(self, root: str, table: str, fold, every: int = 100, keep: bool = False):
        self.root, self.table, self.fold, self.every, self.keep = root, table, fold, every, keep

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """The table as the batches before ``batch_id`` left it."""
        top = batch_before(spark, self.root, self.table + SNAPSHOT, batch_id)
        ids = [b for b in batch_ids(spark, self.root, self.table) if b < batch_id and (top is None or b > top)]
        paths = [os.path.join(self.root, self.table, f"batch_id={b}") for b in ids]
        if top is not None:
            paths.insert(0, os.path.join(self.root, self.table + SNAPSHOT, f"batch_id={top}"))
        return self.fold(spark.read.parquet(*paths)) if paths else None

    def rows(self, spark: SparkSession) -> DataFrame | None:
        return self.before(spark, 1 << 62)

    def write(self, changes: DataFrame, batch_id: int) -> None:
        spark = changes.sparkSession
        write_batch(changes, self.root, self.table, batch_id)
        if (batch_id + 1) % self.every == 0:
            now = self.before(spark, batch_id + 1)
            if now is not None:
                write_batch(now, self.root, self.table + SNAPSHOT, batch_id)
            older = batch_before(spark, self.root, self.table + SNAPSHOT, batch_id)
            if older is not None and not self.keep:
                forget(spark, self.root, self.table, older + 1)
                forget(spark, self.root, self.table + SNAPSHOT, older)
