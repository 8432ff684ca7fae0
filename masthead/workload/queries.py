"""The registered queries: name -> function of (session, data folder) giving a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from masthead.functions.clean import with_clean_headline
from masthead.functions.lead import with_lead_headline
from masthead.functions.payload import snippet, with_content
from masthead.functions.prompt import STOPS, cut_at_stops, render, verdict
from masthead.functions.skip import skip_articles, skip_reason
from masthead.functions.validate import validate_headline, with_format_reason
from masthead.operators.audit import audit_headlines
from masthead.operators.candidates import (
    AUDIT_BATCH,
    AUDIT_WINDOW_S,
    GENERATION_BATCH,
    GENERATION_WINDOW_S,
    any_unverified,
    audit_candidates,
    generation_candidates,
    headline_state,
    newest,
    newest_per_shard,
    pending,
    recent,
    unverified,
)
from masthead.operators.decisions import quarantined
from masthead.operators.generation import generate_headlines
from masthead.operators.inference import HOOK_CALL, ModelRunner
from masthead.operators.updates import (
    apply_decisions,
    reject_and_blank,
    rejection_line,
    rejections,
    undecided,
)
from masthead.plans.jobs import run_generation
from masthead.plans.reports import (
    audit_shard_summary,
    audit_summary,
    format_report,
    generation_summary,
    outcome_report,
    quarantine_report,
    shard_summary,
    skip_report,
    state_report,
)
from masthead.schema import DECISIONS
from masthead.session import ship_package
from masthead.sources.articles import read_articles
from masthead.sources.rejection_table import read_rejections, write_rejections
from masthead.sources.sinks import update_articles, write_articles
from masthead.sources.staging import Staging
from masthead.sources.store import create_store, read_store
from masthead.sources.templates import load_templates
from masthead.streaming.incremental import once_per_id, stream_articles, stream_headlines
from masthead.streaming.once import only_batches_with_data
from masthead.workload.inputs import AS_OF, article_texts, articles, articles_path
from masthead.workload.standin import standin

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 4
SHARD = 1
SHARD_BATCH = 2

_queries: dict[str, Query] = {}


def _query(build: Query) -> Query:
    _queries[build.__name__] = build
    return build


def registered() -> dict[str, Query]:
    return dict(_queries)


def _runner(spark: SparkSession, partitions: int | None = None) -> ModelRunner:
    ship_package(spark)
    return ModelRunner(standin, partitions=partitions)


# ---- candidates --------------------------------------------------------------------------------------


@_query
def pending_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generation_candidates(articles(spark, sf_dir), AS_OF, GENERATION_BATCH).select("id", "scraped_at")


@_query
def pending_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = generation_candidates(articles(spark, sf_dir), AS_OF, GENERATION_BATCH, shards=SHARDS, number=SHARD)
    return chosen.select("id", "scraped_at")


@_query
def audit_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_candidates(articles(spark, sf_dir), AS_OF, AUDIT_BATCH).select("id", "scraped_at", "rephrased_title")


@_query
def audit_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = audit_candidates(articles(spark, sf_dir), AS_OF, AUDIT_BATCH, shards=SHARDS, number=SHARD)
    return chosen.select("id", "scraped_at", "rephrased_title")


@_query
def pending_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generation_candidates(articles(spark, sf_dir), AS_OF, limit=None).select("id", "scraped_at")


@_query
def newest_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A large batch out of the articles of all ages."""
    return newest(articles(spark, sf_dir), 12_000).select("id", "scraped_at")


@_query
def all_shards_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    waiting = unverified(recent(articles(spark, sf_dir), AS_OF, AUDIT_WINDOW_S)).select("id", "scraped_at")
    return newest_per_shard(waiting, SHARDS, 20).select("id", "shard", F.col("rn").cast("bigint").alias("rn"))


@_query
def headline_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state_report(articles(spark, sf_dir))


@_query
def article_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles(spark, sf_dir).select("id", headline_state().alias("state"))


@_query
def has_unverified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return any_unverified(articles(spark, sf_dir), AS_OF)


# ---- text rules --------------------------------------------------------------------------------------


@_query
def skip_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    reason = skip_reason(F.col("title"), F.col("content"))
    return article_texts(spark, sf_dir).select("id", reason.alias("skip_reason"))


@_query
def kept_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skip_articles(article_texts(spark, sf_dir)).select("id")


@_query
def skip_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skip_report(article_texts(spark, sf_dir))


@_query
def clean_headlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_clean_headline(article_texts(spark, sf_dir), "raw", "clean").select("id", "clean")


@_query
def format_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = with_clean_headline(article_texts(spark, sf_dir), "raw", "clean")
    checked = with_format_reason(cleaned, "clean", "reason")
    return checked.select("id", F.col("reason").isNull().alias("valid"), "reason")


@_query
def format_check_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = article_texts(spark, sf_dir)
    return texts.select("id", validate_headline(F.col("raw")).alias("check")).select("id", "check.*")


@_query
def format_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = with_clean_headline(article_texts(spark, sf_dir), "raw", "clean")
    return format_report(cleaned, "clean", "lang", "source")


@_query
def lead_headlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_lead_headline(article_texts(spark, sf_dir), "content", "headline").select("id", "headline")


@_query
def waiting_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every waiting article would be given without a model, and whether that passes the format check."""
    waiting = generation_candidates(articles(spark, sf_dir), AS_OF, limit=None)
    unpacked = with_content(waiting.select("id", "scraped_at", "rephrased_article"))
    leads = with_format_reason(with_lead_headline(unpacked, "content", "headline"), "headline", "reason")
    return leads.select("id", "scraped_at", "headline", F.col("reason").isNull().alias("valid"), "reason")


# ---- payload and prompts -----------------------------------------------------------------------------


@_query
def inflated_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    unpacked = with_content(articles(spark, sf_dir).select("id", "rephrased_article"))
    return unpacked.select(
        "id",
        F.length("content").cast("bigint").alias("n_chars"),
        F.md5(F.col("content").cast("binary")).alias("content_md5"),
        "corrupt",
    )


@_query
def snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    unpacked = with_content(articles(spark, sf_dir).select("id", "rephrased_article"))
    return unpacked.select("id", snippet(F.col("content")).alias("snippet"))


@_query
def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    templates = load_templates()
    seen = article_texts(spark, sf_dir).select("id", snippet(F.col("content")).alias("snippet"), "raw")
    body = F.col("snippet")
    return seen.select(
        "id",
        F.md5(render(templates.hook, body_snippet=body).cast("binary")).alias("hook_md5"),
        F.md5(render(templates.safe, body_snippet=body).cast("binary")).alias("safe_md5"),
        F.md5(render(templates.critic, body_snippet=body, headline=F.col("raw")).cast("binary")).alias(
            "critic_md5"
        ),
    )


@_query
def stop_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = article_texts(spark, sf_dir)
    kind = F.col("id") % 4
    answer = F.concat(
        F.lit(" "),
        "raw",
        F.when(kind == 0, f"{STOPS[0]} {STOPS[1]}").when(kind == 1, f"{STOPS[2]}{STOPS[0]}").otherwise(""),
        F.when(kind == 2, f" {STOPS[1]} {STOPS[2]}").otherwise(""),
        "title",
    )
    return texts.select("id", cut_at_stops(F.coalesce(answer, "raw")).alias("text"))


@_query
def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads the title of every article as if it were the answer of a critic."""
    texts = article_texts(spark, sf_dir)
    answer = F.concat(F.when(F.col("id") % 2 == 0, F.lit("yes, ")).otherwise(""), "title")
    return texts.select("id", verdict(answer).alias("verdict"))


# ---- model jobs, with the stand-in model -------------------------------------------------------------


@_query
def generate_standin(spark: SparkSession, sf_dir: str) -> DataFrame:
    unpacked = with_content(articles(spark, sf_dir).select("id", "rephrased_article"))
    prompt = render(load_templates().hook, body_snippet=snippet(F.col("content")))
    answered = _runner(spark).generate(unpacked.select("id", prompt.alias("prompt")), F.col("prompt"), HOOK_CALL, "a")
    return answered.select("id", "a.text", "a.error")


@_query
def critic_standin(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = article_texts(spark, sf_dir).select("id", snippet(F.col("content")).alias("snippet"), "raw")
    # The texts come as one file; the calls are spread over all cores.
    runner = _runner(spark, partitions=spark.sparkContext.defaultParallelism)
    judged = runner.critique(runner.spread(seen), load_templates().critic, F.col("raw"), "critic")
    return judged.select("id", "critic.approved", "critic.error")


def _generated(spark: SparkSession, chosen: DataFrame) -> DataFrame:
    return generate_headlines(chosen, _runner(spark), load_templates(), Staging(spark))


def _audited(spark: SparkSession, chosen: DataFrame) -> DataFrame:
    return audit_headlines(chosen, _runner(spark), load_templates(), Staging(spark))


_OUTPUT = ["id", "headline", "verified", "outcome", "stage", "reason", "error"]


@_query
def generation_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over every article, whatever its state and age."""
    return _generated(spark, articles(spark, sf_dir)).select(*_OUTPUT)


@_query
def audit_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over every unverified headline, whatever its age."""
    return _audited(spark, unverified(articles(spark, sf_dir))).select(*_OUTPUT)


@_query
def updated_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after a generation run over everything that waits within the window."""
    table = articles(spark, sf_dir)
    waiting = generation_candidates(table, AS_OF, limit=None)
    updated = apply_decisions(table, _generated(spark, waiting), AS_OF - GENERATION_WINDOW_S)
    return updated.select("id", "rephrased_title", "headline_verified")


@_query
def audited_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after an audit of every unverified headline."""
    table = articles(spark, sf_dir)
    updated = apply_decisions(table, _audited(spark, unverified(table)))
    return updated.select("id", "rephrased_title", "headline_verified")


@_query
def stored_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table, days and all, after a generation run has been written into it."""
    table = articles(spark, sf_dir)
    path = Staging(spark).path("articles")
    write_articles(table, path)
    decisions = _generated(spark, generation_candidates(read_articles(spark, path), AS_OF, limit=None))
    update_articles(spark, path, decisions, AS_OF - GENERATION_WINDOW_S)
    stored = read_articles(spark, path)
    return stored.select("id", "rephrased_title", "headline_verified", F.col("scraped_day").cast("bigint"))


@_query
def undecided_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = articles(spark, sf_dir)
    return undecided(table, _generated(spark, table)).select("id")


@_query
def rejected_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejections(_generated(spark, articles(spark, sf_dir))).drop("ts")


@_query
def rejected_repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejections(_audited(spark, unverified(articles(spark, sf_dir)))).drop("ts")


@_query
def rejection_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    run_time = F.timestamp_seconds(F.lit(AS_OF))
    rejected = rejections(_generated(spark, articles(spark, sf_dir)), run_time)
    path = Staging(spark).path("rejections")
    for _ in range(2):  # as after a failure; nothing is there twice
        write_rejections(rejected, path, "run-1")
    return read_rejections(spark, path).select("id", rejection_line(F.col("ts")).alias("line"))


@_query
def blanked_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = articles(spark, sf_dir)
    rejected = rejections(_generated(spark, table)).filter(F.col("stage") == "format")
    return reject_and_blank(table, rejected).select("id", "rephrased_title", "headline_verified")


@_query
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The articles whose text a generation run over everything could not read."""
    table = articles(spark, sf_dir)
    return quarantined(_generated(spark, table), table).select("id", "cause")


@_query
def quarantine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = articles(spark, sf_dir)
    return quarantine_report(quarantined(_generated(spark, table), table))


@_query
def generation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of a run of a full batch."""
    waiting = generation_candidates(articles(spark, sf_dir), AS_OF, GENERATION_BATCH)
    return generation_summary(_generated(spark, waiting), GENERATION_BATCH)


@_query
def generation_counts_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of a run over everything that waits within the window."""
    return generation_summary(_generated(spark, generation_candidates(articles(spark, sf_dir), AS_OF)))


@_query
def generation_shard_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of one run over all shards, of two articles each."""
    chosen = generation_candidates(articles(spark, sf_dir), AS_OF, SHARD_BATCH, shards=SHARDS, all_shards=True)
    return shard_summary(_generated(spark, chosen.select("id", "title", "rephrased_article")), SHARDS, SHARD_BATCH)


@_query
def audit_shard_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of one audit run over all shards, of two articles each, and which of them have more to do."""
    table = articles(spark, sf_dir)
    chosen = audit_candidates(table, AS_OF, SHARD_BATCH, shards=SHARDS, all_shards=True)
    decisions = _audited(spark, chosen)
    updated = apply_decisions(table, decisions, AS_OF - AUDIT_WINDOW_S)
    return audit_shard_summary(decisions, updated, AS_OF, SHARDS)


@_query
def side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table after the runs of all shards, started together, have written into it."""
    staging = Staging(spark)
    store = staging.path("store")
    create_store(articles(spark, sf_dir), store)

    def one(number: int) -> None:
        run_generation(
            spark, read_store(spark, store), _runner(spark), load_templates(), staging.path(f"run-{number}"), AS_OF,
            shards=SHARDS, number=number, store=store,
        )

    with ThreadPoolExecutor(SHARDS) as pool:
        list(pool.map(one, range(SHARDS)))
    return read_store(spark, store).select("id", "rephrased_title", "headline_verified", F.col("scraped_day").cast("bigint"))


@_query
def audit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = articles(spark, sf_dir)
    decisions = _audited(spark, audit_candidates(table, AS_OF, limit=None))
    return audit_summary(decisions, apply_decisions(table, decisions, AS_OF - AUDIT_WINDOW_S), AS_OF)


@_query
def outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcome_report(_generated(spark, articles(spark, sf_dir)))


@_query
def audit_outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcome_report(_audited(spark, unverified(articles(spark, sf_dir))))


# ---- streaming ---------------------------------------------------------------------------------------


@_query
def streamed_headlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article files as a stream, four files at a time, into a stored table that is empty at first."""
    staging = Staging(spark)
    store = staging.path("store")
    create_store(articles(spark, sf_dir).limit(0), store)
    run = stream_headlines(
        stream_articles(spark, articles_path(spark, sf_dir), files_per_batch=4),
        _runner(spark),
        load_templates(),
        staging.path("stream"),
        staging.path("checkpoint"),
        as_of=lambda: AS_OF,
        store=store,
    )
    run.awaitTermination()
    return read_store(spark, store).select("id", "rephrased_title", "headline_verified")


@_query
def streamed_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same stream without a table: the log of its decisions, in two runs, of which the second brings back what failed."""
    staging = Staging(spark)
    out = staging.path("stream")
    for _ in range(2):
        run = stream_headlines(
            stream_articles(spark, articles_path(spark, sf_dir)),
            _runner(spark),
            load_templates(),
            out,
            staging.path("checkpoint"),
            as_of=lambda: AS_OF,
        )
        run.awaitTermination()
    log = spark.read.schema(f"{DECISIONS}, batch_id bigint").parquet(out)
    tried = log.groupBy("id").agg(F.count(F.lit(1)).alias("times"))
    return log.groupBy("id").agg(F.max_by(F.struct("headline", "verified", "outcome"), "batch_id").alias("last")).join(tried, "id").select(
        "id", "last.headline", "last.verified", "last.outcome", "times"
    )


@_query
def arrivals_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every article arrives twice; how often each gets through."""
    staging = Staging(spark)
    table = articles(spark, sf_dir)
    staging.save(table.unionByName(table), "arrivals")
    arrivals = stream_articles(spark, staging.path("arrivals"), files_per_batch=8)
    writer = (
        once_per_id(arrivals)
        .select("id")
        .writeStream.format("parquet")
        .option("checkpointLocation", staging.path("checkpoint"))
        .trigger(availableNow=True)
    )
    with only_batches_with_data(spark):
        run = writer.start(staging.path("first"))
    run.awaitTermination()
    passed = spark.read.schema("id bigint").parquet(staging.path("first"))
    return passed.groupBy("id").agg(F.count(F.lit(1)).alias("n"))


@_query
def still_waiting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What still waits after one generation run over the window, as the next run would see it."""
    table = articles(spark, sf_dir)
    waiting = pending(recent(table, AS_OF, GENERATION_WINDOW_S))
    updated = apply_decisions(table, _generated(spark, waiting), AS_OF - GENERATION_WINDOW_S)
    return pending(recent(updated, AS_OF, GENERATION_WINDOW_S)).select("id")
