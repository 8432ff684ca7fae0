"""How the calls of a model are dealt to tasks."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from masthead.operators.generation import generate_headlines
from masthead.operators.inference import CALL_CHARS, CHARS_PER_TASK, ModelRunner, deal
from masthead.sources.staging import Staging
from tests.scripted import TEMPLATES, Script
from tests.test_cascades import GENERATION, check, packed


def work_by_task(dealt):
    rows = dealt.groupBy(F.spark_partition_id()).agg(F.sum(F.col("chars") + CALL_CHARS), F.count("*")).collect()
    return [row[1] for row in rows], [row[2] for row in rows]


def test_tasks_hold_equal_work(spark):
    """Nine of ten prompts are short; the long ones, all in the first of eight partitions, are 400 times as long."""
    long = F.col("id") < 2_000
    df = spark.range(0, 20_000, 1, 8).withColumn("chars", F.when(long, 20_000 + F.col("id") % 7_000).otherwise(F.col("id") % 60))
    per_task = 1_000_000
    work, rows = work_by_task(deal(df, F.col("chars"), per_task))
    total = df.agg(F.sum(F.col("chars") + CALL_CHARS)).first()[0]
    assert len(work) == -(-total // per_task)
    assert sum(rows) == 20_000
    assert max(work) < 1.4 * total / len(work) and min(work) > 0.6 * total / len(work)
    assert max(rows) > 10 * min(rows)  # by number they could not be even


def test_rows_are_dealt_alike_every_time(spark):
    df = spark.range(5_000).withColumn("chars", F.col("id") % 1_500)
    dealt = deal(df, F.col("chars"), 100_000).select("id", F.spark_partition_id().alias("task"))
    again = deal(df.repartition(13), F.col("chars"), 100_000).select("id", F.spark_partition_id().alias("task"))
    assert dealt.exceptAll(again).isEmpty()


def test_few_or_no_rows_are_one_task(spark):
    df = spark.range(10).withColumn("chars", F.when(F.col("id") > 2, F.lit(1)))  # an unknown length counts as none
    dealt = deal(df, F.col("chars"), CHARS_PER_TASK)
    assert dealt.rdd.getNumPartitions() == 1 and dealt.count() == 10
    assert deal(df.filter("id < 0"), F.col("chars"), CHARS_PER_TASK).count() == 0


def test_a_runner_deals_by_work_unless_told_otherwise():
    assert ModelRunner(Script).by_work
    assert not ModelRunner(Script, partitions=3).by_work
    assert not ModelRunner(Script, rows_per_task=3).by_work
    assert not ModelRunner(Script, chars_per_task=None).by_work


def test_decisions_do_not_depend_on_it(spark, tmp_path):
    rows = [(n, "title", packed(case[0])) for n, case in enumerate(GENERATION.values())]
    df = spark.createDataFrame(rows, "id bigint, title string, rephrased_article binary")
    asked = []
    for n, chars in enumerate((None, 1_500)):
        (tmp_path / str(n)).mkdir()
        script = Script(str(tmp_path / str(n)))
        check(GENERATION, generate_headlines(df, ModelRunner(script, 2, chars_per_task=chars), TEMPLATES, Staging(spark)))
        asked.append(Counter(script.calls()))
    assert asked[0] == asked[1]
