"""Session helpers: small driver-made tables and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

# Upper bound for any table this library broadcasts.
MAX_BROADCAST_ROWS = 1 << 20


def small_table(spark: SparkSession, columns: dict[str, pa.Array]) -> DataFrame:
    """A broadcast-hinted DataFrame over driver-made columns of bounded length."""
    table = pa.table(columns)
    if table.num_rows > MAX_BROADCAST_ROWS:
        raise ValueError(
            f"{table.num_rows} rows are too many to broadcast; join a stored table instead, "
            "or raise blockmill.session.MAX_BROADCAST_ROWS"
        )
    return F.broadcast(spark.createDataFrame(table))


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint for a table whose row count is known to be small enough."""
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS else df


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a private one only where unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    configured = configured or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    configured = tempfile.mkdtemp(prefix="blockmill-")
    spark.conf.set("spark.checkpoint.dir", configured)
    return configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder for a table written between two jobs."""
    return f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows of a table, written to the shared folder and read back.

    Cuts the lineage for good: what reads the result starts from files.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    where = hadoop.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _file_system(spark, path)
    return files.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that is no longer needed, if it is there."""
    files, where = _file_system(spark, path)
    files.delete(where, True)


def make_folder(spark: SparkSession, path: str) -> None:
    files, where = _file_system(spark, path)
    files.mkdirs(where)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none where there is no folder."""
    files, where = _file_system(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(where)) if files.exists(where) else []


def create_file(spark: SparkSession, path: str, data: bytes) -> None:
    """Write a small new file from the driver; one that exists is never replaced."""
    files, where = _file_system(spark, path)
    try:
        out = files.create(where, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName() or files.exists(where):
            raise FileExistsError(path) from None
        raise
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def default_parallelism(spark: SparkSession) -> int:
    return max(1, spark.sparkContext.defaultParallelism)


_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_LISTINGS_PER_CORE = 4


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """While tables are opened here, a few tasks list their folders, not one task each.

    With a folder for each shard a listing would otherwise have as many tasks as there
    are shards, each of which sends its metrics to the driver.
    """
    before = spark.conf.get(_LISTING)
    spark.conf.set(_LISTING, str(min(int(before), _LISTINGS_PER_CORE * default_parallelism(spark))))
    try:
        yield
    finally:
        spark.conf.set(_LISTING, before)


_MANAGER = "spark.sql.streaming.checkpointFileManagerClass"
_PLAIN_MANAGER = "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"


@contextmanager
def plain_renames(spark: SparkSession, *paths: str) -> Iterator[None]:
    """While a stream is started and run here, its logs in local folders are renamed in the JVM.

    Spark's usual way asks for the links of both names before each rename, for which Hadoop
    starts processes on a local disk. Other stores, and a way that is set, are left alone.
    """
    schemes = {_file_system(spark, p)[0].getUri().getScheme() for p in paths}
    if schemes != {"file"} or spark.conf.get(_MANAGER, None):
        yield
        return
    spark.conf.set(_MANAGER, _PLAIN_MANAGER)
    try:
        yield
    finally:
        spark.conf.unset(_MANAGER)
