"""Session settings and the shared folder for data written between stages."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Adaptive execution does the work that cannot be planned up front: it joins by
# broadcast only once the measured size allows it, merges small shuffle
# partitions and splits the partition of a hot key over many tasks.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def build_session(app_name: str = "quayside", master: str | None = None, **settings) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**CLUSTER_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can read, named by ``spark.checkpoint.dir``.

    A machine-local temporary folder is used only by a local session that names
    none; on a cluster a missing setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="quayside-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


_working: ContextVar[str | None] = ContextVar("working", default=None)


def new_run_folder(spark: SparkSession, purpose: str) -> str:
    return f"{_working.get() or shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def working_folder(spark: SparkSession):
    """Everything that is written to the shared folder within goes when the block ends.

    What the block returns must not be read afterwards from there, so it suits work
    that ends with a written result.
    """
    path = new_run_folder(spark, "work")
    token = _working.set(path)
    try:
        yield path
    finally:
        _working.reset(token)
        remove_folder(spark, path)


def cut_lineage(df):
    """Write the rows to the shared folder and read them from there.

    They survive the loss of the executors that made them, and as a columnar table they
    carry their size, so later joins are planned knowing it.
    """
    spark = df.sparkSession
    path = new_run_folder(spark, "rows")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
