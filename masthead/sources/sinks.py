"""Writing results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from masthead.operators.updates import apply_decisions, rejection_line, written
from masthead.schema import DAY_COLUMN, DAY_S
from masthead.sources.articles import read_articles
from masthead.sources.staging import Staging


def write_articles(articles: DataFrame, path: str) -> None:
    """Store the article table, one folder per day.

    Rows are rebalanced by day, so that a day is written in few files; days that are too large for one task are
    split again at run time.
    """
    by_day = articles.withColumn(DAY_COLUMN, F.expr(f"scraped_at div {DAY_S}"))
    by_day.hint("rebalance", DAY_COLUMN).write.partitionBy(DAY_COLUMN).parquet(path)


def update_articles(spark: SparkSession, path: str, decisions: DataFrame, since: int) -> None:
    """Write decisions into a table stored by :func:`write_articles`.

    Only the days from ``since`` on that hold a decided article are read whole and replaced. The new days are staged in
    full before the old ones go. If replacing them fails, the staged copy stays, and the exception names it:
    :func:`replace_days` with that copy finishes the update. Nothing else may write to those days meanwhile; where
    articles keep arriving, use a table format with row-level changes and ``merge_decisions``.
    """
    recent = read_articles(spark, path).filter(F.col(DAY_COLUMN) >= since // DAY_S)
    hit = recent.select("id", DAY_COLUMN).join(written(decisions).select("id"), "id", "left_semi")
    days = [row[DAY_COLUMN] for row in hit.select(DAY_COLUMN).distinct().collect()]  # at most the days of the window
    if not days:
        return
    staging = Staging(spark)
    try:
        updated = staging.save(apply_decisions(recent.filter(F.col(DAY_COLUMN).isin(days)), decisions), "days")
    except Exception:
        staging.close()
        raise
    try:
        replace_days(updated, path)
    except Exception as failure:
        failure.add_note(f"the new days are complete in {staging.path('days')}")
        raise
    staging.close()


def replace_days(updated: DataFrame, path: str) -> None:
    """Replace the days of a stored table that occur in ``updated``. Repeating it changes nothing."""
    (
        updated.hint("rebalance", DAY_COLUMN)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY_COLUMN)
        .parquet(path)
    )


def append_rejections(rejected: DataFrame, path: str) -> None:
    """Append to the rejections table, one folder per day."""
    by_day = rejected.withColumn("run_date", F.to_date("ts"))
    by_day.write.mode("append").partitionBy("run_date").parquet(path)


def replace_rejections(rejected: DataFrame, path: str) -> None:
    """Write the rejections of one run to a folder of its own, one folder per day. Repeating it changes nothing but the time."""
    by_day = rejected.withColumn("run_date", F.to_date("ts"))
    by_day.write.mode("overwrite").partitionBy("run_date").parquet(path)


def append_rejection_log(rejected: DataFrame, path: str) -> None:
    """Append to the rejections as lines of text."""
    rejected.select(rejection_line(F.col("ts")).alias("value")).write.mode("append").text(path)
