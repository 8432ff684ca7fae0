"""Headlines for articles as they arrive."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from masthead.functions.payload import SNIPPET_CHARS
from masthead.operators.candidates import GENERATION_WINDOW_S, pending, recent
from masthead.operators.generation import generate_headlines
from masthead.operators.inference import ModelRunner
from masthead.operators.updates import rejections
from masthead.schema import ARTICLE_COLUMNS, ARTICLES, DECISIONS
from masthead.sources.staging import Staging
from masthead.sources.store import update_store
from masthead.sources.templates import Templates
from masthead.streaming.once import ATTEMPT, KEEP_S, only_batches_with_data, passing

RETRY_S = 600.0


def _now() -> int:
    return int(time.time())


def stream_articles(spark, path: str, files_per_batch: int | None = None, form: str = "parquet") -> DataFrame:
    """Article files as they land in a folder. ``files_per_batch`` bounds a micro-batch."""
    reader = spark.readStream.schema(ARTICLES).format(form)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def once_per_id(stream: DataFrame, keep_s: int = KEEP_S) -> DataFrame:
    """Only the first arrival of every article, whatever its dates. Ids are remembered for ``keep_s`` seconds of the clock."""
    return passing(stream.withColumn(ATTEMPT, F.lit(0)), keep_s).drop(ATTEMPT)


def stream_headlines(
    stream: DataFrame,
    model: ModelRunner,
    templates: Templates,
    out: str,
    checkpoint: str,
    as_of: Callable[[], int] = _now,
    window_s: int = GENERATION_WINDOW_S,
    once: bool = True,
    snippet_chars: int | None = SNIPPET_CHARS,
    store: str | None = None,
    trigger_s: float | None = None,
    retry_s: float = RETRY_S,
    keep_s: int = KEEP_S,
) -> StreamingQuery:
    """Decide headlines for everything that has arrived, and stop; with ``trigger_s``, look again that often and go on.

    Every micro-batch writes its decisions to ``<out>/batch_id=<n>`` and the rejected texts to
    ``<out>/_rejections/batch_id=<n>``, replacing what an earlier attempt at the same batch left, so a replayed batch
    changes nothing. With ``store``, a table of :func:`masthead.sources.store.create_store`, arrivals it does not hold are added
    to it and the decisions written into it, as one new version for each micro-batch. Started again on the same
    checkpoint, only new files are taken. The age rule uses the clock of the micro-batch, like a batch run.

    With ``once``, an article that has arrived is not taken again for ``keep_s`` seconds; keyed state remembers its id, and
    nothing is read of what was decided before. Articles that failed are written to ``<out>/_retry``, which the stream reads as
    well. They are tried again as long as they are in the window: by a run that ends, in the next run, with or without new
    files; by one that goes on, after ``retry_s`` seconds, twice as long after each further failure. A new arrival of
    a failed article takes its place.
    """
    spark = stream.sparkSession
    again = f"{out}/_retry"
    _make_folder(spark, again)
    failed = spark.readStream.schema(f"{ARTICLES}, {ATTEMPT} int").parquet(again)
    rows = stream.select(*ARTICLE_COLUMNS).withColumn(ATTEMPT, F.lit(0)).unionByName(failed)
    if once:
        rows = passing(rows, keep_s, 0 if trigger_s is None else retry_s)

    def decide_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        now = as_of()
        with Staging(session) as staging:
            arrived = staging.save(batch, "arrived")
            due = recent(pending(arrived), now, window_s)
            if not once:
                due = due.dropDuplicates(["id"])
            chosen = staging.save(due.select("id", "title", "rephrased_article"), "due")
            if chosen.isEmpty():
                decisions = session.createDataFrame([], DECISIONS)
            else:
                decisions = generate_headlines(chosen, model, templates, staging, snippet_chars)
            decisions.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
            decided = session.read.schema(DECISIONS).parquet(f"{out}/batch_id={batch_id}")
            rejected = rejections(decided, F.timestamp_seconds(F.lit(now)))
            rejected.write.mode("overwrite").parquet(f"{out}/_rejections/batch_id={batch_id}")
            if store is not None:
                new = arrived.drop(ATTEMPT).dropDuplicates(["id"])
                update_store(session, store, decided, now - window_s, new, source=out, batch=batch_id)
            lost = staging.save(due.join(decided.filter("outcome = 'error'").select("id"), "id", "left_semi"), "failed")
            if not lost.isEmpty():  # a replay adds them a second time, which the state makes up for
                lost.withColumn(ATTEMPT, F.col(ATTEMPT) + 1).write.mode("append").parquet(again)

    writer = rows.writeStream.foreachBatch(decide_batch).option("checkpointLocation", checkpoint)
    if trigger_s is not None:
        return writer.trigger(processingTime=f"{trigger_s} seconds").start()
    with only_batches_with_data(spark):
        return writer.trigger(availableNow=True).start()


def _make_folder(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
