"""Session settings and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "rosterlake", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without that
    setting gets a temporary folder, removed when the process ends; a cluster without it is an
    error, because a machine-local path would be lost with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        if spark.sparkContext.getCheckpointDir() is None:  # set after the session had started
            spark.sparkContext.setCheckpointDir(folder)
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="rosterlake-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a small helper table: it survives the loss of any executor."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def store(df: DataFrame, label: str = "stored") -> DataFrame:
    """The table written to the shared folder and read back.

    For results that several later steps read: they are computed once, each reader scans only its
    columns, and joins see real sizes.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def over_all_cores(df: DataFrame) -> DataFrame:
    """A table scan whose rows are dealt over all cores if it has fewer partitions than cores.

    A few files of one row group each would leave all work up to the next shuffle to a few tasks, and broadcast joins
    need no shuffle. A larger table is returned as it is. Only for scans: a plan with a shuffle would run it to be counted.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.isStreaming or df.rdd.getNumPartitions() >= cores else df.repartition(cores)


@contextmanager
def small_methods(spark: SparkSession):
    """While this is open, plans whose one generated method would pass 8000 bytes run as several.

    HotSpot never compiles a longer method, so a projection of many cleaned columns would be interpreted row by row.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    earlier = spark.conf.get(name)
    spark.conf.set(name, "8000")
    try:
        yield
    finally:
        spark.conf.set(name, earlier)


@contextmanager
def freed_shuffles(spark: SparkSession):
    """While this is open, the shuffle files of a query go when it ends.

    Else they stay until the driver happens to collect its garbage, so a job of several stored steps holds the shuffles of
    all of them. A table that is read twice within the job should be stored, or its shuffles run again.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    earlier = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, earlier)


def ship_with_tasks(module) -> None:
    """Send a module's functions inside the task, so workers need no installed package."""
    cloudpickle.register_pickle_by_value(module)
