"""Session set-up and the shared scratch folder that cuts lineage."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_LIMIT = 64 << 20
"""Largest side, in bytes, that an operator broadcasts after measuring it."""


def local_session(cores: int = 8, partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("threadloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    Where it is unset, a session on one machine takes a folder of its own for
    as long as the process lives; on a cluster that is an error, since what one
    executor wrote to its own disk no other could read.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return _own_dir()


@functools.cache
def _own_dir() -> str:
    folder = tempfile.mkdtemp(prefix="threadloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return "file://" + folder


def delete_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder on whatever file system it lies."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there; errors other than its absence are raised."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none if it is not there."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in system.listStatus(target)) if system.exists(target) else []


_WRITTEN: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession):
    """Deletes, on leaving, the tables that ``materialise`` wrote inside the block.

    Results must be written or counted before that.
    """
    _WRITTEN.append([])
    try:
        yield
    finally:
        for path in _WRITTEN.pop():
            delete_path(spark, path)


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/threadloom-{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    A block of ``scratch`` deletes it at its end; else it stays in the folder.
    The table survives the loss of an executor, and later stages start from it
    rather than from the plan that made it, so the shuffle files of that plan
    go as soon as the table is written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if _WRITTEN:
        _WRITTEN[-1].append(path)
    with _shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def _shuffles_removed(spark: SparkSession):
    """Queries that end inside the block take their shuffle files with them."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def broadcast_if_small(df: DataFrame, n_bytes: int, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Broadcast ``df`` only when its measured size is under ``limit``."""
    return F.broadcast(df) if n_bytes <= limit else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
