"""File-system helpers through the cluster's Hadoop FileSystem (HDFS, object
stores and local paths alike), so paths are the same ones Spark reads."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.delete(p, True)) if fs.exists(p) else False


def list_dir(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(str(s.getPath().getName()) for s in fs.listStatus(p))


def data_files(spark: SparkSession, path: str) -> list[str]:
    """A file itself, or the visible files below a directory (no ``_`` / ``.``)."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    todo, found = [fs.getFileStatus(p)], []
    while todo:
        status = todo.pop()
        if status.isFile():
            found.append(str(status.getPath()))
        else:
            todo += [s for s in fs.listStatus(status.getPath())
                     if not s.getPath().getName().startswith(("_", "."))]
    return sorted(found)
