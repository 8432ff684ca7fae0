"""Counts over decisions and headlines. All of them aggregate partially before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from masthead.functions.skip import skip_reason
from masthead.functions.validate import reason_kind, with_format_reason
from masthead.operators.candidates import AUDIT_WINDOW_S, any_unverified, headline_state, recent, unverified


def _count(*outcomes: str) -> Column:
    return F.count_if(F.col("outcome").isin(*outcomes))


def generation_summary(decisions: DataFrame, batch: int | None = None) -> DataFrame:
    """Counters of a generation run. Only model headlines count as processed. ``has_more`` says that the batch
    was full, so it is also true when the batch was an exact fit."""
    loaded = F.count(F.lit(1))
    return decisions.agg(
        loaded.alias("loaded"),
        _count("hook", "safe").alias("processed"),
        _count("fallback", "format_fallback").alias("fallback"),
        _count("error").alias("errors"),
        (F.lit(False) if batch is None else loaded == batch).alias("has_more"),
    )


def _by_shard(decisions: DataFrame, shards: int) -> DataFrame:
    """The decisions with a row more for each shard, without an outcome, so that a shard without work is counted too."""
    every = decisions.sparkSession.range(shards).select(F.col("id").alias("shard"), F.lit(None).cast("string").alias("outcome"))
    return decisions.select((F.col("id") % shards).alias("shard"), "outcome").unionByName(every)


def shard_summary(decisions: DataFrame, shards: int, batch: int | None = None) -> DataFrame:
    """The counters of a generation run over all shards, a row for each shard. ``has_more`` says that the shard's batch was full."""
    loaded = F.count("outcome")
    return (
        _by_shard(decisions, shards)
        .groupBy("shard")
        .agg(
            loaded.alias("loaded"),
            _count("hook", "safe").alias("processed"),
            _count("fallback", "format_fallback").alias("fallback"),
            _count("error").alias("errors"),
            (F.lit(False) if batch is None else loaded == batch).alias("has_more"),
        )
    )


def audit_shard_summary(decisions: DataFrame, updated: DataFrame, as_of: int, shards: int, window_s: int = AUDIT_WINDOW_S) -> DataFrame:
    """The counters of an audit run over all shards, a row for each shard. ``has_more``: the shard got something done and has more to audit."""
    counts = (
        _by_shard(decisions, shards)
        .groupBy("shard")
        .agg(
            F.count("outcome").alias("loaded"),
            _count("validated").alias("validated"),
            _count("fixed", "fallback").alias("fixed"),
            _count("error").alias("llm_failures"),
        )
    )
    left = unverified(recent(updated, as_of, window_s)).filter(F.col("id") >= 0).select((F.col("id") % shards).alias("shard")).distinct()
    left = left.withColumn("_left", F.lit(True))
    progress = F.col("validated") + F.col("fixed") > 0
    return counts.join(left, "shard", "left").withColumn("has_more", progress & F.coalesce("_left", F.lit(False))).drop("_left")


def audit_summary(
    decisions: DataFrame, updated: DataFrame, as_of: int, window_s: int = AUDIT_WINDOW_S
) -> DataFrame:
    """Counters of an audit run; a lead headline counts as fixed. ``updated`` is the table after the update.

    ``has_more`` asks whether that table holds more to audit, and is false after a run that got nothing done.
    """
    counts = decisions.agg(
        F.count(F.lit(1)).alias("loaded"),
        _count("validated").alias("validated"),
        _count("fixed", "fallback").alias("fixed"),
        _count("error").alias("llm_failures"),
    )
    progress = F.col("validated") + F.col("fixed") > 0
    return counts.withColumn("has_more", progress & any_unverified(updated, as_of, window_s).scalar())


def outcome_report(decisions: DataFrame) -> DataFrame:
    """Decisions per stage and outcome."""
    return decisions.groupBy("stage", "outcome").agg(F.count(F.lit(1)).alias("n"))


def quarantine_report(quarantined: DataFrame) -> DataFrame:
    """Unreadable articles per cause."""
    return quarantined.groupBy("cause").agg(F.count(F.lit(1)).alias("n"))


def format_report(df: DataFrame, headline: str, *dims: str) -> DataFrame:
    """Headlines per format reason (``valid`` for good ones), and subtotals over ``dims`` from the last to the
    first. ``level`` is the number of dimensions a row sums over, so that a subtotal is told from a NULL in the data.

    Rows are counted at the finest level first, so the rollup expands the few counts and not the rows.
    """
    checked = with_format_reason(df.select(*dims, headline), headline, "_reason")
    reason = F.coalesce(reason_kind(F.col("_reason")), F.lit("valid"))
    finest = checked.select(*dims, reason.alias("reason")).groupBy(*dims, "reason").agg(F.count(F.lit(1)).alias("n"))
    summed = sum((F.grouping(d).cast("bigint") for d in dims), F.lit(0).cast("bigint"))
    subtotals = finest.rollup("reason", *dims).agg(
        F.sum("n").alias("n"), F.grouping("reason").alias("_all"), summed.alias("level")
    )
    return subtotals.filter(F.col("_all") == 0).select(*dims, "level", "reason", "n")


def skip_report(df: DataFrame, title: str = "title", content: str = "content") -> DataFrame:
    """Articles per skip rule; a NULL rule counts those that are kept."""
    reason = skip_reason(F.col(title), F.col(content))
    return df.groupBy(reason.alias("skip_reason")).agg(F.count(F.lit(1)).alias("n"))


def state_report(articles: DataFrame) -> DataFrame:
    """Articles per headline state."""
    return articles.groupBy(headline_state().alias("state")).agg(F.count(F.lit(1)).alias("n"))
