"""Which articles need work: state, age and shard filters, newest first, bounded batches.

All filters are plain predicates on stored columns, so they reach the scan. ``as_of`` (epoch seconds) is
always an argument; nothing here reads the clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from masthead.schema import DAY_COLUMN, DAY_S

# How far back the two jobs look, and the batch sizes one may ask for. Without a size, a run takes all.
GENERATION_WINDOW_S = 86400
AUDIT_WINDOW_S = 3 * 86400
GENERATION_BATCH = 10
AUDIT_BATCH = 20


def recent(df: DataFrame, as_of: int, window_s: int) -> DataFrame:
    """Articles scraped no longer than ``window_s`` seconds before ``as_of``, the border included.

    In a table partitioned by day, older days are not even listed.
    """
    since = as_of - window_s
    if DAY_COLUMN in df.columns:
        df = df.filter(F.col(DAY_COLUMN) >= since // DAY_S)
    return df.filter(F.col("scraped_at") >= since)


def pending(df: DataFrame) -> DataFrame:
    """Articles without a headline that have a text."""
    return df.filter(F.col("rephrased_title").isNull() & F.col("rephrased_article").isNotNull())


def _unchecked() -> Column:
    return F.col("headline_verified").isNull() | (F.col("headline_verified") == 0)


def unverified(df: DataFrame) -> DataFrame:
    """Articles whose headline has not been audited. A headline of blanks counts; an empty one does not."""
    return df.filter(F.col("rephrased_title").isNotNull() & (F.col("rephrased_title") != "") & _unchecked())


def shard(df: DataFrame, shards: int = 1, number: int | None = None) -> DataFrame:
    """One of ``shards`` slices by ``id``; without a number, or with one shard, everything."""
    if number is None or shards <= 1:
        return df
    return df.filter(F.col("id") % shards == number)


def newest(df: DataFrame, limit: int | None) -> DataFrame:
    """The ``limit`` newest articles (all without a limit); of equally old ones, the higher ids. Undated ones come last,
    and of rows that agree in both, as many are taken as there is room for.

    The top-k gathers the two key columns alone; the articles meet the chosen keys by an equi-join, so no task holds
    the batch with its texts, however large it is.
    """
    if limit is None:
        return df
    columns = df.columns
    keys = df.select("scraped_at", "id").orderBy(F.desc("scraped_at"), F.desc("id")).limit(limit)
    keys = keys.groupBy(F.col("scraped_at").alias("_at"), F.col("id").alias("_id")).agg(F.count(F.lit(1)).alias("_room"))
    same = F.col("scraped_at").eqNullSafe(F.col("_at")) & F.col("id").eqNullSafe(F.col("_id"))
    copies = Window.partitionBy("_at", "_id").orderBy(F.lit(0))
    chosen = df.join(keys, same).withColumn("_nth", F.row_number().over(copies))
    return chosen.filter(F.col("_nth") <= F.col("_room")).select(*columns)


def newest_per_shard(df: DataFrame, shards: int, limit: int, salts: int = 16) -> DataFrame:
    """The ``limit`` newest articles of every shard, with columns ``shard`` and ``rn``.

    Ranked twice: first within each of ``salts`` parts of a shard, then among what is left of the shard, which
    is at most ``salts * limit`` rows however many the shard has. The first of a shard are the first of
    their part, so nothing is lost. Negative ids belong to no shard.
    """
    newest_first = [F.desc("scraped_at"), F.desc("id")]
    parts = Window.partitionBy("shard", "_salt").orderBy(*newest_first)
    whole = Window.partitionBy("shard").orderBy(*newest_first)
    return (
        df.filter(F.col("id") >= 0)
        .withColumn("shard", F.col("id") % shards)
        .withColumn("_salt", F.pmod(F.hash("id"), F.lit(salts)))
        .withColumn("_rank", F.row_number().over(parts))
        .filter(F.col("_rank") <= limit)
        .withColumn("rn", F.row_number().over(whole))
        .filter(F.col("rn") <= limit)
        .drop("_salt", "_rank")
    )


def newest_of_all_shards(df: DataFrame, shards: int, limit: int) -> DataFrame:
    """The ``limit`` newest articles of every shard. Ranks the two key columns alone; the articles meet the chosen ids by an
    equi-join. Ids are unique."""
    keys = newest_per_shard(df.select("scraped_at", "id"), shards, limit).select("id")
    return df.join(keys, "id", "left_semi")


def headline_state() -> Column:
    """pending, unverified, verified or parked; NULL for an article without headline and text."""
    title = F.col("rephrased_title")
    return (
        F.when(title.isNull() & F.col("rephrased_article").isNotNull(), "pending")
        .when(title == "", "parked")
        .when(title.isNotNull() & _unchecked(), "unverified")
        .when(title.isNotNull(), "verified")
    )


def any_unverified(df: DataFrame, as_of: int, window_s: int = AUDIT_WINDOW_S) -> DataFrame:
    """One row, one column ``has_more``: is any headline of the window left to audit, in whatever shard?

    Every task stops at its first hit.
    """
    left = unverified(recent(df, as_of, window_s)).select("id").limit(1)
    return left.agg((F.count("id") > 0).alias("has_more"))


def generation_candidates(
    articles: DataFrame,
    as_of: int,
    limit: int | None = None,
    window_s: int = GENERATION_WINDOW_S,
    shards: int = 1,
    number: int | None = None,
    all_shards: bool = False,
) -> DataFrame:
    """What a generation run works on; with ``all_shards``, the batches of all shards, of ``limit`` each."""
    return _chosen(pending(recent(articles, as_of, window_s)), limit, shards, number, all_shards)


def audit_candidates(
    articles: DataFrame,
    as_of: int,
    limit: int | None = None,
    window_s: int = AUDIT_WINDOW_S,
    shards: int = 1,
    number: int | None = None,
    all_shards: bool = False,
) -> DataFrame:
    """What an audit run works on; with ``all_shards``, the batches of all shards, of ``limit`` each."""
    return _chosen(unverified(recent(articles, as_of, window_s)), limit, shards, number, all_shards)


def _chosen(df: DataFrame, limit: int | None, shards: int, number: int | None, all_shards: bool) -> DataFrame:
    if not all_shards:
        return newest(shard(df, shards, number), limit)
    if number is not None:
        raise ValueError("a run takes one shard or all of them")
    return df.filter(F.col("id") >= 0) if limit is None else newest_of_all_shards(df, shards, limit)
