"""Session helpers: a local session for tests and benches, and shipping this package to the executors."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "masthead", **conf: str) -> SparkSession:
    """A single-machine session. On a cluster the session comes from spark-submit instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        # Methods beyond the JIT's limit (the text rules fuse into one) are split by expression instead of being interpreted.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # Building a job makes thousands of column calls; do not note where each came from.
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, whatever directory the driver was started in.

    With spark-submit, pass the package through ``--py-files`` instead.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="masthead-package-")
    archive = shutil.make_archive(
        os.path.join(folder, "masthead"), "zip", os.path.dirname(package), os.path.basename(package)
    )
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)
