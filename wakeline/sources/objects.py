"""Archive batches as objects of their own, one JSON array each.

The sink is a Python data source: tasks write their objects into a staging folder, and only the commit of the whole job
moves them to their names, so a failed task or job leaves nothing that a reader sees (tasks that still run when a
job is given up may leave files in its staging folder, which readers skip). An object's name comes
with its row, so writing the same rows again replaces objects by equal ones.

Any file system that pyarrow knows by its address can hold the objects (local, HDFS, S3, GCS). A batch is an object of
a few hundred records here, as the reference has it; the line archive of ``sources.io`` suits large backfills better.
"""

from __future__ import annotations

import posixpath
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from wakeline.schemas import RAW_EVENT

FORMAT = "wakeline_objects"
STAGING = "_staging-"


def _store(address: str):
    """The file system of an address (a URI or a local path) and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(address) if "://" in address or address.startswith("file:") else (
        fs.LocalFileSystem(), address)


@dataclass
class Staged(WriterCommitMessage):
    """What a task wrote: the objects' names and the task's own staging folder."""

    folder: str
    names: list[str]


class ObjectWriter(DataSourceWriter):
    def __init__(self, path: str):
        self.path = path.rstrip("/")
        self.staging = posixpath.join(self.path, STAGING + uuid.uuid4().hex)

    def write(self, rows: Iterator) -> Staged:
        store, base = _store(self.staging)
        # An attempt of a task never meets another's files.
        folder = posixpath.join(base, uuid.uuid4().hex)
        names = []
        for row in rows:
            at = posixpath.join(folder, row["name"])
            store.create_dir(posixpath.dirname(at), recursive=True)
            with store.open_output_stream(at) as out:
                out.write(row["value"].encode("utf-8"))
            names.append(row["name"])
        return Staged(folder, names)

    def commit(self, messages) -> None:
        store, base = _store(self.path)
        for m in messages:
            for name in m.names if m is not None else ():
                to = posixpath.join(base, name)
                store.create_dir(posixpath.dirname(to), recursive=True)
                store.move(posixpath.join(m.folder, name), to)
        self._tidy()

    def abort(self, messages) -> None:
        self._tidy()

    def _tidy(self) -> None:
        from pyarrow import fs

        store, base = _store(self.staging)
        if store.get_file_info(base).type != fs.FileType.NotFound:
            store.delete_dir(base)


class ObjectSource(DataSource):
    """Write-only data source of rows (name, value): an object per row."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "name string, value string"

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceWriter:
        return ObjectWriter(self.options["path"])


def write_objects(objects: DataFrame, path: str) -> None:
    """Publish rows (name, value) as objects under ``path``, all of them or none. Names must be unique."""
    # The planning worker does not see files added to the session, so this module travels by value.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark = objects.sparkSession
    spark.dataSource.register(ObjectSource)
    objects.select(F.col("name").cast("string"), F.col("value").cast("string")).write.format(FORMAT).mode("append").save(path)


def read_objects(spark: SparkSession, path: str, schema: T.StructType = RAW_EVENT) -> DataFrame:
    """Rows (object, pos, record's fields) of the JSON-array objects under ``path``, whoever wrote them.

    An element may be an object or a text that holds one. An object that is no JSON array gives one row whose
    ``pos`` and fields are null, so that it can be found. Staged objects are not seen.
    """
    texts = spark.read.text(path, wholetext=True, pathGlobFilter="*.json", recursiveFileLookup=True).select(
        F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)$", 1).alias("object"), "value")
    whole = F.try_parse_json(F.col("value"))
    items = F.try_variant_get(whole, "$", "array<variant>")
    rows = texts.select("object", F.posexplode_outer(items).alias("pos", "_item"))
    text = F.coalesce(F.try_variant_get("_item", "$", "string"), F.to_json("_item"))
    return rows.select("object", "pos", F.from_json(text, schema).alias("_e")).select("object", "pos", "_e.*")
