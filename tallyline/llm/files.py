"""Files on storage that every executor reaches, by the storage's own address."""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import SparkSession


def address(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as the cluster's file system settings complete it."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(found).toString()


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The Arrow file system for an address and the path on it. Local, HDFS, S3, GCS and ABFS addresses are known."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(uri)
