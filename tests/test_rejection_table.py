"""The table of rejections: runs are there whole and once."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from masthead.schema import REJECTIONS
from masthead.sources.rejection_table import read_rejections, write_rejections


def rejected(spark, ids, text="bad"):
    rows = spark.range(min(ids), max(ids) + 1, numPartitions=3).filter(F.col("id").isin(list(ids)))
    return rows.select(
        F.timestamp_seconds(F.lit(1_700_000_000)).alias("ts"), "id", F.lit("hook").alias("stage"),
        F.concat(F.lit(f"{text} "), "id").alias("generated"), F.when(F.col("id") % 2 == 0, "why").alias("reason"),
    )


def found(spark, path):
    df = read_rejections(spark, path)
    assert df.schema.simpleString() == spark.createDataFrame([], REJECTIONS).schema.simpleString()
    return sorted((r["id"], r["generated"]) for r in df.collect())


def test_runs_are_written_once(spark, tmp_path):
    path = str(tmp_path / "rejections")
    assert found(spark, path) == []
    write_rejections(rejected(spark, [1, 2, 5]), path, "run-1")
    write_rejections(rejected(spark, [7]), path, "run-2.batch-0")
    want = [(1, "bad 1"), (2, "bad 2"), (5, "bad 5"), (7, "bad 7")]
    assert found(spark, path) == want
    write_rejections(rejected(spark, [1, 2, 5]), path, "run-1")
    assert found(spark, path) == want
    write_rejections(rejected(spark, [1], "new"), f"file:{path}", "run-1")
    assert found(spark, path) == [(1, "new 1"), (7, "bad 7")]
    write_rejections(rejected(spark, [3]).filter("id > 3"), path, "run-1")
    assert found(spark, path) == [(7, "bad 7")]


def test_aborted_writes_leave_nothing(spark, tmp_path):
    path = str(tmp_path / "rejections")
    write_rejections(rejected(spark, [1, 2]), path, "run-1")
    before = set(os.listdir(f"{path}/data"))
    fails = F.when(F.col("id") == 9, F.raise_error(F.lit("no more power"))).otherwise(F.col("generated"))
    with pytest.raises(Exception, match="no more power"):
        write_rejections(rejected(spark, range(1, 10)).withColumn("generated", fails), path, "run-1")
    assert found(spark, path) == [(1, "bad 1"), (2, "bad 2")]
    listed = {os.path.basename(f) for f in os.listdir(f"{path}/data")}
    assert before <= listed
    write_rejections(rejected(spark, range(1, 10)), path, "run-1")
    assert [n for n, _ in found(spark, path)] == list(range(1, 10))


def test_names_and_modes(spark, tmp_path):
    with pytest.raises(Exception, match="letters, digits"):
        write_rejections(rejected(spark, [1]), str(tmp_path), "a/b")
    with pytest.raises(Exception, match="use append"):
        rejected(spark, [1]).write.format("masthead_rejections").option("path", str(tmp_path)).option("run", "r").mode("overwrite").save()
