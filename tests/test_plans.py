"""What the optimizer makes of the operators: the properties the jobs rely on at scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from masthead.functions.clean import with_clean_headline
from masthead.functions.lead import with_lead_headline
from masthead.functions.payload import with_content
from masthead.functions.prompt import render
from masthead.functions.validate import with_format_reason
from masthead.operators.candidates import (
    any_unverified,
    audit_candidates,
    generation_candidates,
    newest_per_shard,
    shard,
)
from masthead.operators.decisions import with_lead, with_snippet
from masthead.operators.inference import HOOK_CALL, ModelRunner
from masthead.operators.updates import apply_decisions, undecided
from masthead.plans.reports import audit_summary, format_report
from masthead.schema import DECISIONS
from masthead.sources.articles import read_articles
from masthead.workload.standin import standin

NOW = 1_700_000_000


@pytest.fixture(scope="module")
def articles(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "articles")
    spark.range(50).select(
        "id",
        F.lit("t").alias("title"),
        F.lit(b"x").alias("rephrased_article"),
        (NOW - F.col("id")).alias("scraped_at"),
        F.when(F.col("id") % 2 == 0, "h").alias("rephrased_title"),
        F.lit(0).alias("headline_verified"),
    ).write.parquet(path)
    return read_articles(spark, path)


@pytest.fixture(scope="module")
def decisions(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "decisions")
    spark.createDataFrame([(1, "h", 0, "hook", "hook_critic", None, None, [])], DECISIONS).write.parquet(path)
    return spark.read.schema(DECISIONS).parquet(path)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text: str) -> list[str]:
    return re.findall(r"FileScan parquet.*", text)


def test_candidate_filters_and_columns_reach_the_scan(articles):
    text = plan(generation_candidates(articles, NOW, None).select("id", "scraped_at"))
    for pushed in ("IsNull(rephrased_title)", "IsNotNull(rephrased_article)", "GreaterThanOrEqual(scraped_at"):
        assert pushed in text
    assert "title#" not in scans(text)[0].split("Batched")[0].replace("rephrased_title#", "")
    text = plan(audit_candidates(articles, NOW, None).select("id"))
    assert "Or(IsNull(headline_verified),EqualTo(headline_verified,0))" in text
    assert "rephrased_article" not in scans(text)[0]


def test_batches_are_a_top_k_of_keys(articles):
    text = plan(generation_candidates(articles, NOW, 10))
    assert "TakeOrderedAndProject" in text
    assert "Exchange rangepartitioning" not in text
    assert "Cartesian" not in text and "NestedLoop" not in text
    assert sorted("title#" in scan.replace("rephrased_title#", "") for scan in scans(text)) == [False, True]


def test_shards_are_limited_before_the_shuffle(articles):
    text = plan(newest_per_shard(articles.select("id", "scraped_at"), 4, 20))
    assert text.count("WindowGroupLimit") == 4
    assert text.rindex("Partial") > text.rindex("Exchange")  # the first limit runs below the first shuffle


@pytest.mark.parametrize("rule", ["clean", "lead"])
def test_text_rules_are_one_stage_without_python_or_shuffle(articles, rule):
    if rule == "clean":
        df = with_clean_headline(articles, "rephrased_title", "out")
        df = with_format_reason(df, "out", "reason").select("id", "out", "reason")
    else:
        df = with_lead_headline(articles, "title", "out").select("id", "out")
    text = plan(df)
    assert "EvalPython" not in text and "Exchange" not in text
    nodes = [line for line in text.splitlines() if re.match(r"^\W*(\*\(\d+\) )?(Project|ColumnarToRow|Filter)\b", line)]
    assert nodes and all("*(1)" in line for line in nodes)
    assert len(text) < 60_000


def test_model_stage_has_no_shuffle_and_a_small_plan(articles):
    inputs = with_snippet(articles.select("id", "rephrased_article"))
    prompt = render("Write. {body_snippet}", body_snippet=F.col("snippet"))
    staged = with_lead(ModelRunner(standin).generate(inputs, prompt, HOOK_CALL, "hook"))
    text = plan(staged)
    assert "Exchange" not in text
    assert text.count("ArrowEvalPython") == 2
    assert len(text) < 60_000


def test_rows_are_spread_before_they_are_unpacked(articles):
    packed = articles.select("id", "rephrased_article")
    text = plan(with_snippet(ModelRunner(standin, partitions=7).spread(packed)))
    assert text.index("ArrowEvalPython") < text.index("Exchange hashpartitioning(id")
    for rows, expected in ((10, 5), (7, 8), (1000, 1)):
        spread = ModelRunner(standin, partitions=3, rows_per_task=rows).spread(packed)
        assert spread.rdd.getNumPartitions() == expected


def test_text_is_not_unpacked_where_it_is_not_read(articles):
    text = plan(with_content(articles).select("id", "rephrased_title"))
    assert "EvalPython" not in text
    assert "rephrased_article" not in scans(text)[0]


def test_update_reads_each_part_of_the_table_once(spark, articles, decisions):
    text = plan(apply_decisions(articles, decisions, NOW - 10))
    table_scans = [scan for scan in scans(text) if "rephrased_article" in scan]
    assert len(table_scans) == 2
    assert "GreaterThanOrEqual(scraped_at" in table_scans[0]
    assert "LessThan(scraped_at" in table_scans[1]
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_update_sorts_and_merges_when_decisions_are_large(spark, articles, decisions):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        assert "SortMergeJoin" in plan(apply_decisions(articles, decisions))
        assert "SortMergeJoin" in plan(undecided(articles, decisions))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_summaries_join_nothing_but_the_update(articles, decisions):
    text = plan(audit_summary(decisions, apply_decisions(articles, decisions), NOW))
    assert "Cartesian" not in text and "NestedLoop" not in text
    assert "rephrased_article" not in text.split("Subquery")[0]


def test_reports_count_before_they_expand(articles):
    text = plan(format_report(articles, "rephrased_title", "title"))
    assert text.index("Expand") < text.rindex("partial_count")


def test_probe_stops_early(articles):
    text = plan(any_unverified(articles, NOW))
    assert "LocalLimit 1" in text


def test_shard_is_a_plain_filter(articles):
    assert "Exchange" not in plan(shard(articles, 4, 1))
