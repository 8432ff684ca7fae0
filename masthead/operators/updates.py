"""Writing decisions back to the articles, and the log of rejected texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from masthead.schema import DAY_COLUMN, DAY_S

def written(decisions: DataFrame) -> DataFrame:
    """The decisions that change an article; failed rows do not."""
    return decisions.filter(F.col("outcome") != "error")


def latest_decisions(decisions: DataFrame, order: str = "batch_id") -> DataFrame:
    """One decision per id out of a log of several runs or micro-batches: the last one that was written."""
    whole = F.struct(*[c for c in decisions.columns])
    last = written(decisions).groupBy("id").agg(F.max_by(whole, order).alias("_last"))
    return last.select("_last.*")


def _split(articles: DataFrame, since: int | None) -> tuple[DataFrame, DataFrame | None]:
    """The articles scraped from ``since`` on, and the others; in a table partitioned by day, neither reads the
    other's days."""
    if since is None:
        return articles, None
    at = F.col("scraped_at")
    newer, older = at >= since, (at < since) | at.isNull()
    if DAY_COLUMN in articles.columns:
        day = F.col(DAY_COLUMN)
        newer, older = newer & (day >= since // DAY_S), older & ((day <= since // DAY_S) | day.isNull())
    return articles.filter(newer), articles.filter(older)


def apply_decisions(articles: DataFrame, decisions: DataFrame, since: int | None = None) -> DataFrame:
    """The articles with the decided headlines and flags.

    Ids in ``decisions`` must be unique; unknown ones change nothing. Articles scraped before ``since`` cannot
    have a decision and bypass the join, so a large history is neither shuffled nor sorted. Catalyst
    broadcasts the decisions if their measured size allows and sort-merges otherwise.
    """
    columns = articles.columns
    changes = written(decisions).select(
        "id", F.col("headline").alias("_headline"), F.col("verified").alias("_verified"), F.lit(True).alias("_hit")
    )
    touched, rest = _split(articles, since)
    updated = (
        touched.join(changes, "id", "left")
        .withColumn("rephrased_title", _replaced("_headline", "rephrased_title"))
        .withColumn("headline_verified", _replaced("_verified", "headline_verified"))
        .select(*columns)
    )
    return updated if rest is None else updated.unionByName(rest)


def _replaced(new: str, old: str) -> Column:
    return F.when(F.col("_hit"), F.col(new)).otherwise(F.col(old))


def merge_decisions(decisions: DataFrame, table: str) -> None:
    """The same update in place, for a catalog table whose format supports row-level changes."""
    (
        written(decisions)
        .alias("d")
        .mergeInto(table, F.col("d.id") == F.col(f"{table}.id"))
        .whenMatched()
        .update({"rephrased_title": F.col("d.headline"), "headline_verified": F.col("d.verified")})
        .merge()
    )


def undecided(candidates: DataFrame, decisions: DataFrame) -> DataFrame:
    """Candidates nothing was written for; the next run meets them again."""
    return candidates.join(written(decisions).select("id"), "id", "left_anti")


def rejections(decisions: DataFrame, ts: Column | None = None) -> DataFrame:
    """Every rejected text as ``ts, id, stage, generated, reason``; ``ts`` is the time of the run by default."""
    ts = F.current_timestamp() if ts is None else ts
    return decisions.select("id", F.inline("attempts")).select(
        ts.alias("ts"), "id", "stage", "generated", "reason"
    )


def rejection_line(ts: Column) -> Column:
    """One rejection as a line of the log file. Fixed value: the form of the line."""
    return F.concat(
        F.lit("["), F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit("] Article ID: "), F.col("id").cast("string"),
        F.lit(" | Stage: "), F.col("stage"), F.lit(" | Generated: '"), F.col("generated"),
        F.lit("' | Reason: "), F.col("reason"),
    )


def reject_and_blank(
    articles: DataFrame, rejected: DataFrame, dry_run: bool = False, since: int | None = None
) -> DataFrame:
    """Blank the headline of every rejected article, leaving its flag alone; a dry run changes nothing.

    ``rejected`` may hold several rows per article. Articles scraped before ``since`` are left alone and bypass the
    join.
    """
    if dry_run:
        return articles
    ids = rejected.select("id").distinct().withColumn("_hit", F.lit(True))
    title = F.when(F.col("_hit"), "").otherwise(F.col("rephrased_title"))
    touched, rest = _split(articles, since)
    blanked = touched.join(ids, "id", "left").withColumn("rephrased_title", title).select(*articles.columns)
    return blanked if rest is None else blanked.unionByName(rest)
