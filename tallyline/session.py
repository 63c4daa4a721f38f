"""Session settings and working folders."""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is the cluster's ``spark.checkpoint.dir``, or a folder below the warehouse where that is unset. A folder of one
    machine is refused unless the master is local.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    shared = shared or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    if shared.startswith("file:") and not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"{shared} is on one machine; set spark.checkpoint.dir to a folder shared by the cluster")
    return shared.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, in the application's own folder (see ``release``)."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def materialize(rows: DataFrame, name: str) -> DataFrame:
    """Write the rows to the shared folder once and go on from there, for results that are read repeatedly."""
    return materialize_at(rows, name)[0]


def materialize_at(rows: DataFrame, name: str, *by: str, group_bytes: int | None = None) -> tuple[DataFrame, str]:
    """As ``materialize``, with the folder, to be removed when what was made from the rows is written itself; ``by`` are its last columns, which part it.

    ``group_bytes`` is the size of row groups, if not Parquet's.
    """
    path = scratch_dir(rows.sparkSession, name)
    writer = rows.write.option("parquet.block.size", group_bytes) if group_bytes else rows.write
    writer.partitionBy(*by).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path), path


def _located(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """A folder or pattern, and its file system."""
    located = spark._jvm.org.apache.hadoop.fs.Path(path)
    return located, located.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    folder, files = _located(spark, path)
    files.delete(folder, True)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Files and folders of a pattern."""
    located, files = _located(spark, pattern)
    return [status.getPath().toString() for status in files.globStatus(located) or []]


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files below a folder."""
    folder, files = _located(spark, path)
    return files.getContentSummary(folder).getLength()


def release(spark: SparkSession) -> None:
    """Remove what this application has written to the shared folder, once its results have been used."""
    remove(spark, f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def uncompressed_cache(spark: SparkSession) -> Iterator[None]:
    """What is persisted in the meantime is kept as it is: looking for the best encoding of a column costs more than a few reads of it save.

    The setting counts at the call of ``persist``, when the rows are planned, and not when they are made.
    """
    with _setting(spark, "spark.sql.inMemoryColumnarStorage.compressed", "false"):
        yield


@contextmanager
def shuffles_end_with_query(spark: SparkSession) -> Iterator[None]:
    """A stream that is started in the meantime removes the shuffles of each batch at its end.

    Otherwise Spark removes them when the driver's garbage is collected, so those of all batches may be on disk at once.
    """
    with _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        yield


def drop_shuffles(spark: SparkSession) -> None:
    """Free the disk of shuffles whose DataFrames are not referred to any more.

    Spark removes them when the driver's garbage is collected, which a driver with memory to spare may not do
    for half an hour. The first of two collections only frees what refers to them.
    """
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.2)
