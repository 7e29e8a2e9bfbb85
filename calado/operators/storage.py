"""Cutting lineage in loops, in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Where it is unset a local master, as in tests, gets a new temporary folder; on a cluster that is an error, as
    driver and executors do not share local folders."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="calado-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


#: Folders that are deleted when the process ends.
_LEFT: set[str] = set()


def _removed_at_exit(spark: SparkSession, path: str) -> None:
    """Have a folder of this application deleted when the process ends; one that is gone by then, or a session that ended before, is no error."""

    def remove() -> None:
        try:
            jvm = spark.sparkContext._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # noqa: BLE001  the session has ended before the process
            pass

    if path not in _LEFT:
        _LEFT.add(path)
        atexit.register(remove)


def checkpointed(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder, deleted when the process ends. Sessions that live long may set
    ``spark.cleaner.referenceTracking.cleanCheckpoints``, with which Spark deletes those that nothing refers to any more."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_root(df.sparkSession))
    _removed_at_exit(df.sparkSession, context._jsc.sc().getCheckpointDir().get())
    return df.checkpoint()


def stored(df: DataFrame) -> tuple[DataFrame, str]:
    """The rows of ``df`` written to the shared folder and read from there, and their path: loops ``deleted`` it once the next round is written, so
    that rounds do not add up on disk. Shuffle files of the write go with it, as nothing else reads them."""
    spark, path = df.sparkSession, shared_path(df.sparkSession, "round")
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
    return spark.read.schema(df.schema).parquet(path), path


def deleted(spark: SparkSession, path: str) -> None:
    """Delete what ``stored`` wrote and nothing reads any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share, deleted when the process ends."""
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    _removed_at_exit(spark, path)
    return path
