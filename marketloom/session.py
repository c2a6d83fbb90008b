"""Session settings and durable intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Of stored tables; they take about a quarter less than with Parquet's default.
CODEC = "zstd"
# Scratch tables of the job that runs inside ``temporary``.
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Only tables whose known size on disk is below this are broadcast.
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    # Dictionary-coded columns are larger in memory than on disk; the size that decides about a broadcast allows for it.
    "spark.sql.sources.fileCompressionFactor": "3",
}
# On a cluster a shuffle starts with many partitions, which AQE merges to the size it wants; it never splits ordinary ones.
CLUSTER_SETTINGS = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192"}


def build_session(app: str = "marketloom", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the library's settings; ``settings`` (dots written as ``__``) override them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    cluster = {} if master and master.startswith("local") else CLUSTER_SETTINGS
    for key, value in {**SETTINGS, **cluster, **{k.replace("__", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for durable intermediate tables, seen by every executor.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may go without: it gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="marketloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder; one sub-folder per application makes old ones easy to find."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def drop_durable(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application, when its jobs are done."""
    delete_folder(spark, f"{shared_folder(spark)}/{spark.sparkContext.applicationId}")


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write that is started inside go when it ends, and not some time after the driver's garbage collection."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder that the caller made."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(df: DataFrame) -> None:
    """Delete the files of a durable table that nothing reads any more."""
    own = f"{shared_folder(df.sparkSession)}/{df.sparkSession.sparkContext.applicationId}/"
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if own in folder:
            delete_folder(df.sparkSession, folder)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Durable tables that are made inside go at the end: for a job that has then written its results elsewhere."""
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield
    finally:
        _MADE.reset(token)
        for path in made:
            delete_folder(spark, path)


def durable(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage so that a lost executor costs a re-read and not a re-computation, and gives Catalyst the real size
    of the table: a join then broadcasts it only if that size is below the broadcast threshold.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    made = _MADE.get()
    if made is not None:
        made.append(path)
    with shuffles_removed(spark):
        df.write.option("compression", CODEC).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
