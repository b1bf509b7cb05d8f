"""Session settings the operators rely on."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_RUNTIME = {
    # Every timestamp in the data model is a UTC instant.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key's partition even if the next step then needs a shuffle of its own.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the SQL options the operators assume; safe to call repeatedly."""
    for key, value in _RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


# Partitions are joined up to this many compressed bytes where wide rows are sorted for several
# joins in one task: a row takes some twenty times its compressed size there.
TASK_BYTES = "16m"


_BROADCAST, _BROADCAST_MEASURED = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"


def join_by_measured_size(spark: SparkSession) -> SparkSession:
    """Broadcast a table without being told to only where its rows, once shuffled, are within the
    session's limit.

    Before it runs, Spark knows a table by the bytes of its files. Sorted keys take a byte or less
    there and fifty in a hash table, so millions of rows would pass for small and be built into
    one hash table on the driver."""
    limit = spark.conf.get(_BROADCAST)
    if limit != "-1":
        if spark.conf.get(_BROADCAST_MEASURED, None) is None:
            spark.conf.set(_BROADCAST_MEASURED, limit)
        spark.conf.set(_BROADCAST, "-1")
    return spark


def configure_star(spark: SparkSession) -> SparkSession:
    """`configure`, with smaller tasks and no broadcasts by file size for the joins of the star schema."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", TASK_BYTES)
    return configure(join_by_measured_size(spark))


def build_session(app: str = "gleanstar", master: str | None = None, **options: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in options.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


_local_dirs: dict[str, str] = {}
_staged: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder for staged tables: `spark.checkpoint.dir` as the session has it.

    Only a local session may fall back to a temporary folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="gleanstar-")
    return _local_dirs[context.applicationId]


def staging_folder(spark: SparkSession) -> str:
    """A fresh folder below the shared one, deleted by `drop_staged`."""
    folder = os.path.join(shared_dir(spark), "staged", uuid.uuid4().hex)
    _staged.setdefault(spark.sparkContext.applicationId, []).append(folder)
    return folder


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Around a write: its plan runs once, so the files of its shuffles go when it ends, not when
    the driver next collects its garbage. A step of many writes then needs the disk of one."""
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, keeps column pruning
    for the readers, and gives the optimizer a measured size to plan joins with.
    """
    spark = df.sparkSession
    path = os.path.join(staging_folder(spark), name)
    # One file per task whatever the session says: row positions count within a file. Zstandard
    # works on heap buffers; Snappy's direct ones outlive their tasks until the heap fills.
    with shuffles_freed(spark):
        df.write.option("maxRecordsPerFile", 0).option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> int:
    """Delete what this session has staged, once nothing reads it any more; returns the
    number of tables deleted."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    folders = _staged.pop(spark.sparkContext.applicationId, [])
    for folder in folders:
        path = hadoop.Path(folder)
        path.getFileSystem(conf).delete(path, True)
    return len(folders)
