"""Each article once, by keyed state: what has arrived is remembered per id, and what failed comes back after a while."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from masthead.schema import ARTICLE_COLUMNS, ARTICLES

KEEP_S = 7 * 86400  # how long an id is remembered, by the clock
ATTEMPT = "attempt"  # 0: has arrived; n: has failed n times

_PASSED = f"{ARTICLES}, {ATTEMPT} int"
_COLUMNS = [*ARTICLE_COLUMNS, ATTEMPT]
_WAITING = _PASSED.split(",", 1)[1].strip()
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Arrivals(StatefulProcessor):
    """Per id: ``seen`` since when, gone after ``keep_ms``; ``waiting``, the article if it failed and its time has not come.

    The first arrival passes, others do not, unless the article failed: then a new arrival takes its place at once. A failed
    article passes again when its timer fires, ``retry_ms`` after the first failure, twice as long after each further one, or at once
    if that is 0.
    """

    def __init__(self, keep_ms: int, retry_ms: int) -> None:
        self.keep_ms, self.retry_ms = keep_ms, retry_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "at bigint", self.keep_ms)
        self.waiting = handle.getValueState("waiting", _WAITING, self.keep_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803 - names of the interface
        first = last = failed = None
        for row in rows:
            if row[ATTEMPT] > 0:
                failed = row
            else:
                first, last = first or row, row
        if last is not None:
            seen = self.seen.exists()
            waits = self.waiting.exists()
            if failed is not None or waits or not seen:
                if waits:
                    self.waiting.clear()
                self.seen.update((timerValues.getCurrentProcessingTimeInMs(),))
                yield last if failed is not None or seen else first
        elif failed is not None and not self.retry_ms:
            yield failed
        elif failed is not None:
            self.waiting.update(tuple(failed)[1:])
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.retry_ms * 2 ** min(failed[ATTEMPT] - 1, 10))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        if self.waiting.exists():
            row = Row(*_COLUMNS)(key[0], *self.waiting.get())
            self.waiting.clear()
            yield row

    def close(self) -> None:
        pass


def keep_state_in_rocksdb(spark: SparkSession) -> None:
    """Keyed state needs this provider. Other streams of the session get it too."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def passing(stream: DataFrame, keep_s: int = KEEP_S, retry_s: float = 0) -> DataFrame:
    """What is to be worked on of a stream of articles with an ``attempt`` column; see :class:`Arrivals`. Rows without id are dropped.

    Ids are forgotten by the clock of the cluster, so neither late nor future-dated articles are lost, and the state holds what
    arrived within ``keep_s`` seconds, not the whole past.
    """
    keep_state_in_rocksdb(stream.sparkSession)
    processor = Arrivals(int(keep_s * 1000), int(retry_s * 1000))
    keyed = stream.filter("id is not null").select(*_COLUMNS).groupBy("id")
    return keyed.transformWithState(processor, _PASSED, "append", "processingTime").select(*_COLUMNS)


@contextmanager
def only_batches_with_data(spark: SparkSession) -> Iterator[None]:
    """Streams started inside end when all files are read; with timers they would go on with empty batches."""
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)
