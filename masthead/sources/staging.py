"""Staged tables: results of expensive steps, written once and read back.

A model call is slow and need not answer the same twice, so its result is written to parquet before anything
branches on it. The table also cuts the lineage, and unlike cached blocks it outlives lost executors.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, tempfile.TemporaryDirectory] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Only a local session may go without it; it gets a temporary folder that goes away with the process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.conf.get("spark.app.id")
    if app not in _local_roots:
        _local_roots[app] = tempfile.TemporaryDirectory(prefix="masthead-", ignore_cleanup_errors=True)
    return _local_roots[app].name


def is_complete(spark: SparkSession, path: str) -> bool:
    """Has a write to this folder been committed? A job's committer leaves a mark when all its files are in place."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


class Staging:
    """The staged tables of one run. As a context manager it deletes them at the end."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as table ``name`` and return the written table."""
        path = f"{self.folder}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def close(self) -> None:
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.folder)
        folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_) -> None:
        self.close()
