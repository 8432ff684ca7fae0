"""The two batch jobs: choose articles, decide, write."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from masthead.functions.payload import SNIPPET_CHARS
from masthead.operators.audit import audit_headlines
from masthead.operators.candidates import (
    AUDIT_WINDOW_S,
    GENERATION_WINDOW_S,
    audit_candidates,
    generation_candidates,
)
from masthead.operators.decisions import quarantined
from masthead.operators.generation import generate_headlines
from masthead.operators.inference import ModelRunner
from masthead.operators.updates import apply_decisions, rejections
from masthead.plans.reports import audit_shard_summary, audit_summary, generation_summary, shard_summary
from masthead.schema import DECISIONS, QUARANTINE
from masthead.sources.articles import read_articles
from masthead.sources.sinks import replace_rejections, update_articles
from masthead.sources.staging import Staging, is_complete
from masthead.sources.store import is_store, read_store, update_store
from masthead.sources.templates import Templates

Cascade = Callable[[DataFrame, ModelRunner, Templates, Staging, int | None], DataFrame]


@dataclass(frozen=True)
class Run:
    """What a run decided, the articles with that applied, the summary (one row, or one for each shard), and the articles whose
    text could not be read, with the cause."""

    decisions: DataFrame
    articles: DataFrame
    summary: DataFrame
    quarantine: DataFrame


def run_generation(
    spark: SparkSession,
    articles: DataFrame,
    model: ModelRunner,
    templates: Templates,
    out: str,
    as_of: int,
    limit: int | None = None,
    shards: int = 1,
    number: int | None = None,
    store: str | None = None,
    snippet_chars: int | None = SNIPPET_CHARS,
    all_shards: bool = False,
) -> Run:
    """Give waiting articles a headline: all of the window, or with ``limit`` the newest. With ``all_shards``, the newest of every
    shard in one run, and a summary for each shard.

    Writes ``<out>/decisions``, ``<out>/rejections`` and ``<out>/quarantine``. With ``store``, the folder ``articles`` was
    read from, the decisions are also written into the stored table. One of
    :func:`masthead.sources.store.create_store` may be written to by several runs at once. Started again with the same ``out`` after it
    was interrupted, the run keeps complete decisions, asks the model nothing, and does what is left. Prompts
    show the first ``snippet_chars`` characters of an article, or with None all of it.
    """
    chosen = generation_candidates(articles, as_of, limit, GENERATION_WINDOW_S, shards, number, all_shards)
    chosen = chosen.select("id", "title", "rephrased_article")
    rows = _rows(limit, shards, all_shards)
    decisions = _decide(spark, chosen, generate_headlines, model, templates, out, rows, snippet_chars)
    quarantine = _quarantine(spark, articles, decisions, out)
    updated = _update(spark, articles, decisions, as_of - GENERATION_WINDOW_S, store)
    summary = shard_summary(decisions, shards, limit) if all_shards else generation_summary(decisions, limit)
    return Run(decisions, updated, summary, quarantine)


def run_audit(
    spark: SparkSession,
    articles: DataFrame,
    model: ModelRunner,
    templates: Templates,
    out: str,
    as_of: int,
    limit: int | None = None,
    shards: int = 1,
    number: int | None = None,
    store: str | None = None,
    snippet_chars: int | None = SNIPPET_CHARS,
    all_shards: bool = False,
) -> Run:
    """Audit published headlines and repair the refused ones; written like a generation run."""
    chosen = audit_candidates(articles, as_of, limit, AUDIT_WINDOW_S, shards, number, all_shards)
    chosen = chosen.select("id", "rephrased_title", "rephrased_article")
    rows = _rows(limit, shards, all_shards)
    decisions = _decide(spark, chosen, audit_headlines, model, templates, out, rows, snippet_chars)
    quarantine = _quarantine(spark, articles, decisions, out)
    updated = _update(spark, articles, decisions, as_of - AUDIT_WINDOW_S, store)
    summary = audit_shard_summary(decisions, updated, as_of, shards) if all_shards else audit_summary(decisions, updated, as_of)
    return Run(decisions, updated, summary, quarantine)


def _quarantine(spark: SparkSession, articles: DataFrame, decisions: DataFrame, out: str) -> DataFrame:
    """Keep what could not be read; nothing is read again where everything could be."""
    quarantined(decisions, articles).write.mode("overwrite").parquet(f"{out}/quarantine")
    return spark.read.schema(QUARANTINE).parquet(f"{out}/quarantine")


def _rows(limit: int | None, shards: int, all_shards: bool) -> int | None:
    """How many articles a run takes at most."""
    return limit if limit is None or not all_shards else limit * shards


def _decide(
    spark: SparkSession,
    chosen: DataFrame,
    cascade: Cascade,
    model: ModelRunner,
    templates: Templates,
    out: str,
    limit: int | None,
    snippet_chars: int | None,
) -> DataFrame:
    if not is_complete(spark, f"{out}/decisions"):
        _run(spark, chosen, cascade, model, templates, out, limit, snippet_chars)
    decisions = spark.read.schema(DECISIONS).parquet(f"{out}/decisions")
    replace_rejections(rejections(decisions), f"{out}/rejections")
    return decisions


def _run(
    spark: SparkSession,
    chosen: DataFrame,
    cascade: Cascade,
    model: ModelRunner,
    templates: Templates,
    out: str,
    limit: int | None,
    snippet_chars: int | None,
) -> None:
    with Staging(spark) as staging:
        if limit is not None:
            # A small batch comes in one partition; the model should have more.
            chosen = chosen.repartition(max(1, min(limit, spark.sparkContext.defaultParallelism)), "id")
            # Text is unpacked behind the top-k: Spark would otherwise unpack every candidate first.
            chosen = staging.save(chosen, "batch")
        decided = cascade(chosen, model, templates, staging, snippet_chars)
        decided.write.mode("overwrite").parquet(f"{out}/decisions")  # over what an interrupted run left


def _update(
    spark: SparkSession, articles: DataFrame, decisions: DataFrame, since: int, store: str | None
) -> DataFrame:
    if store is None:
        return apply_decisions(articles, decisions, since)
    if is_store(spark, store):
        update_store(spark, store, decisions, since)
        return read_store(spark, store)
    update_articles(spark, store, decisions, since)
    return read_articles(spark, store)
