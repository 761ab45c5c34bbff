"""SparkSession helpers: a local session for tests and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session should carry. Time zone is fixed so that any
# timestamp rendering is stable; all our arithmetic is time-zone free anyway.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


MB = 1 << 20


def cluster_conf(input_bytes: int, total_cores: int, partition_bytes: int = 256 * MB) -> dict[str, str]:
    """Settings sized to the input, for a cluster session (e.g. 100 TB on 1000 executors).

    Scan splits and shuffle partitions target ``partition_bytes`` so a task's
    sort/aggregate buffer fits executor memory and spills rarely; AQE then
    coalesces small partitions and splits skewed join partitions at run time.
    """
    shuffle = max(2 * total_cores, -(-int(input_bytes) // int(partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes * 4),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    }


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "wakeline") -> SparkSession:
    """Local session for tests, benches and examples (never used on a cluster)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for kv in filter(None, os.environ.get("WAKELINE_SPARK_CONF", "").split(",")):
        k, v = kv.split("=", 1)
        builder = builder.config(k.strip(), v.strip())
    builder = builder.config("spark.driver.memory", os.environ.get("WAKELINE_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared (distributed) folder and we only
    read it. Only when it is unset (local tests) do we pick a scratch folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not path:
        current = sc.getCheckpointDir()
        if current:
            return current
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="wakeline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def materialize(df):
    """Cut lineage: write ``df`` to the shared checkpoint folder and read it back.

    Used where an expensive stage (a Python fold) feeds a plan that reads its
    input twice. ``checkpoint`` files survive executor loss, unlike a local
    checkpoint.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class Scratch:
    """Tables between the steps of one operator call, as Parquet in a folder of their own in the checkpoint folder.

    A checkpoint is read with a task for each partition it was written with, however small; Parquet files are read
    several to a task, and the driver keeps track of fewer tasks. The caller drops the folder when nothing reads it any more.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.kept = spark, 0
        self.folder = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def keep(self, df):
        path = f"{self.folder}/{self.kept}"
        self.kept += 1
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        drop_folder(self.spark, self.folder)


_SHIPPED: set = set()


def ship_package(spark) -> None:
    """Make ``wakeline`` importable in the Python workers (once per Spark context).

    Operators that run Python on the executors (the coded speed fold, the
    stateful stream processor) pickle their functions by reference, so the
    package must be on the workers' path; ``addPyFile`` distributes it with
    the job, on a cluster as locally.
    """
    import io
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    path = os.path.join(tempfile.mkdtemp(prefix="wakeline-pkg-"), "wakeline.zip")
    with open(path, "wb") as fh:
        fh.write(buf.getvalue())
    sc.addPyFile(path)
    _SHIPPED.add(key)


BATCH_BYTES = 4 * MB


def small_batches(spark: SparkSession) -> None:
    """Hand rows to Python in Arrow batches of about ``BATCH_BYTES``, unless the session names a size itself.

    Spark's own bound is 64 MB, and a batch is held by the JVM and by the worker at once: with texts, batches of
    10,000 rows can be a large part of an executor's memory.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if key not in spark.conf.getAll:
        spark.conf.set(key, str(BATCH_BYTES))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any file system that Spark can reach."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of our own that nothing reads any more; nothing if it is not there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
