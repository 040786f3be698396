"""File system checks through Hadoop, so that they hold on any store the cluster reads."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    file_system, hadoop_path = _resolve(spark, path)
    return file_system.exists(hadoop_path)


def has_files(spark: SparkSession, path: str, suffix: str = ".parquet") -> bool:
    """Whether any data file lies below the path. Walks lazily and stops at the first hit."""
    file_system, hadoop_path = _resolve(spark, path)
    if not file_system.exists(hadoop_path):
        return False
    files = file_system.listFiles(hadoop_path, True)
    while files.hasNext():
        if files.next().getPath().getName().endswith(suffix):
            return True
    return False


def total_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files below the path."""
    file_system, hadoop_path = _resolve(spark, path)
    return file_system.getContentSummary(hadoop_path).getLength()


def names(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """Names directly below a folder that begin with ``prefix``; none if there is no such folder."""
    file_system, hadoop_path = _resolve(spark, path)
    if not file_system.exists(hadoop_path):
        return []
    found = [status.getPath().getName() for status in file_system.listStatus(hadoop_path)]
    return sorted(name for name in found if name.startswith(prefix))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder this library wrote itself."""
    file_system, hadoop_path = _resolve(spark, path)
    file_system.delete(hadoop_path, True)


def copy(spark: SparkSession, source: str, target: str) -> None:
    """Copy a file or folder within what Hadoop can reach."""
    from_system, from_path = _resolve(spark, source)
    to_system, to_path = _resolve(spark, target)
    files = spark._jvm.org.apache.hadoop.fs.FileUtil
    files.copy(from_system, from_path, to_system, to_path, False, True, spark._jsc.hadoopConfiguration())


def mark(spark: SparkSession, path: str) -> None:
    """Create an empty file, to say that something is complete."""
    file_system, hadoop_path = _resolve(spark, path)
    file_system.create(hadoop_path, True).close()


def version_of(spark: SparkSession, path: str) -> str:
    """Changes with the names, sizes and times of the files directly below the path and one below."""
    file_system, hadoop_path = _resolve(spark, path)
    found = []
    for status in file_system.listStatus(hadoop_path):
        below = file_system.listStatus(status.getPath()) if status.isDirectory() else [status]
        found += [f"{s.getPath()}:{s.getLen()}:{s.getModificationTime()}" for s in below]
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The Parquet table at the path, or an empty typed frame if nothing was written yet."""
    if has_files(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)
