"""The jobs from table to table, in batch and as a stream."""

from __future__ import annotations

import time
import zlib

import pytest
from pyspark import cloudpickle

from masthead.operators.inference import ModelRunner
from masthead.operators.updates import apply_decisions, latest_decisions
from masthead.plans import jobs
from masthead.plans.jobs import run_audit, run_generation
from masthead.schema import ARTICLES, DECISIONS
from masthead.sources.articles import read_articles
from masthead.sources.sinks import write_articles
from masthead.sources.staging import Staging, shared_folder
from masthead.sources.store import create_store, read_store, version
from masthead.streaming import incremental
from masthead.streaming.incremental import stream_articles, stream_headlines
from tests import scripted
from tests.scripted import TEMPLATES, Script

cloudpickle.register_pickle_by_value(scripted)

NOW = 1_700_000_000
TEXT = zlib.compress(b"a good headline here|a safe headline here|a good headline here,A safe headline here")
STUCK = zlib.compress(b"!|!|!")


@pytest.fixture
def script(tmp_path):
    notes = tmp_path / "notes"
    notes.mkdir()
    return Script(str(notes))


@pytest.fixture
def few(spark):
    """Few partitions, as each of keyed state has a Python worker of its own."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def article(n, age=0, title=None, flag=None, text=TEXT):
    return (n, f"title {n}", text, NOW - age, title, flag)


def headlines(df):
    return {row["id"]: (row["rephrased_title"], row["headline_verified"]) for row in df.collect()}


def test_generation_job(spark, tmp_path, script):
    rows = [article(n, age=n) for n in range(12)]
    rows += [article(50, age=90000), article(51, title="has one", flag=0), article(52, text=None)]
    table = spark.createDataFrame(rows, ARTICLES)
    run = run_generation(spark, table, ModelRunner(script), TEMPLATES, str(tmp_path / "1"), NOW, limit=10)
    assert run.summary.first().asDict() == {
        "loaded": 10, "processed": 10, "fallback": 0, "errors": 0, "has_more": True,
    }
    first = headlines(run.articles)
    assert len(first) == len(rows)
    assert [n for n in range(12) if first[n] == ("A good headline here", 0)] == list(range(10))
    assert {n: first[n] for n in (10, 11, 50, 51, 52)} == {
        10: (None, None), 11: (None, None), 50: (None, None), 51: ("has one", 0), 52: (None, None),
    }

    second = run_generation(spark, run.articles, ModelRunner(script), TEMPLATES, str(tmp_path / "2"), NOW, limit=10)
    assert second.summary.first()["loaded"] == 2
    assert second.summary.first()["has_more"] is False
    third = run_generation(spark, second.articles, ModelRunner(script), TEMPLATES, str(tmp_path / "3"), NOW)
    assert third.summary.first()["loaded"] == 0
    assert headlines(third.articles) == headlines(second.articles)


def test_failing_articles_stay_pending(spark, tmp_path, script):
    table = spark.createDataFrame([article(1), article(2, text=STUCK)], ARTICLES)
    run = run_generation(spark, table, ModelRunner(script), TEMPLATES, str(tmp_path / "1"), NOW, limit=None)
    assert headlines(run.articles) == {1: ("A good headline here", 0), 2: (None, None)}
    assert run.summary.first()["errors"] == 1


def test_interrupted_run_is_finished_without_the_model(spark, tmp_path, script, monkeypatch):
    refused = zlib.compress(b"a wrong headline here|a safe headline here|a safe headline here")
    table = spark.createDataFrame([article(1), article(2, text=STUCK), article(3, text=refused)], ARTICLES)
    out = str(tmp_path / "1")

    def interrupted(*_):
        raise RuntimeError("interrupted")

    with monkeypatch.context() as patch:
        patch.setattr(jobs, "replace_rejections", interrupted)
        with pytest.raises(RuntimeError, match="interrupted"):
            run_generation(spark, table, ModelRunner(script), TEMPLATES, out, NOW)
    asked = sorted(p.name for p in (tmp_path / "notes").iterdir())
    for _ in range(2):
        run = run_generation(spark, table, ModelRunner(script), TEMPLATES, out, NOW)
        assert headlines(run.articles) == {
            1: ("A good headline here", 0), 2: (None, None), 3: ("A safe headline here", 0),
        }
        assert 0 < spark.read.parquet(f"{out}/rejections").count() == run.decisions.selectExpr("explode(attempts)").count()
    assert sorted(p.name for p in (tmp_path / "notes").iterdir()) == asked


def test_audit_job(spark, tmp_path, script):
    rows = [article(n, age=n, title="a good headline here", flag=0 if n else None) for n in range(2)]
    rows += [article(2, age=2, title="made up", flag=0), article(3, age=3, title="made up", flag=0, text=STUCK)]
    rows += [article(9, age=300000, title="made up", flag=0), article(8, title="made up", flag=1), article(7)]
    table = spark.createDataFrame(rows, ARTICLES)
    run = run_audit(spark, table, ModelRunner(script), TEMPLATES, str(tmp_path / "1"), NOW, limit=3)
    assert run.summary.first().asDict() == {
        "loaded": 3, "validated": 2, "fixed": 1, "llm_failures": 0, "has_more": True,
    }
    assert headlines(run.articles) == {
        0: ("a good headline here", 1), 1: ("a good headline here", 1), 2: ("A safe headline here", 1),
        3: ("made up", 0), 9: ("made up", 0), 8: ("made up", 1), 7: (None, None),
    }
    # The rest fails: no progress, so no further run is asked for although something is left.
    last = run_audit(spark, run.articles, ModelRunner(script), TEMPLATES, str(tmp_path / "2"), NOW, limit=3)
    assert last.summary.first().asDict() == {
        "loaded": 1, "validated": 0, "fixed": 0, "llm_failures": 1, "has_more": False,
    }
    rejected = spark.read.parquet(str(tmp_path / "1" / "rejections"))
    assert [(r["id"], r["stage"], r["reason"]) for r in rejected.collect()] == [
        (2, "published", "critic answered NO.")
    ]


def test_jobs_on_a_stored_table(spark, tmp_path, script):
    """Generation, then audit, in place; the days before the windows are not touched."""
    store = str(tmp_path / "store")
    rows = [article(n, age=n * 40000) for n in range(12)]
    write_articles(spark.createDataFrame(rows, ARTICLES), store)
    run = run_generation(
        spark, read_articles(spark, store), ModelRunner(script), TEMPLATES, str(tmp_path / "1"), NOW, store=store
    )
    assert run.summary.first()["processed"] == 3
    assert headlines(run.articles) == {
        n: ("A good headline here", 0) if n < 3 else (None, None) for n in range(12)
    }
    audit = run_audit(
        spark, read_articles(spark, store), ModelRunner(script), TEMPLATES, str(tmp_path / "2"), NOW, store=store
    )
    # The critic knows the hook as it was written, not in its cleaned form.
    assert audit.summary.first().asDict() == {
        "loaded": 3, "validated": 0, "fixed": 3, "llm_failures": 0, "has_more": False,
    }
    assert headlines(read_articles(spark, store)) == {
        n: ("A safe headline here", 1) if n < 3 else (None, None) for n in range(12)
    }


def test_staging_is_removed(spark):
    with Staging(spark) as staging:
        staged = staging.save(spark.range(5), "numbers")
        assert staged.count() == 5
        assert staging.folder.startswith(shared_folder(spark))
    from pathlib import Path

    assert not Path(staging.folder).exists()


def test_stream(spark, tmp_path, script, few):
    inbox, out, checkpoint = (str(tmp_path / name) for name in ("inbox", "out", "checkpoint"))

    def run():
        stream = stream_articles(spark, inbox, files_per_batch=1)
        query = stream_headlines(stream, ModelRunner(script), TEMPLATES, out, checkpoint, as_of=lambda: NOW)
        query.awaitTermination()
        log = spark.read.schema(f"{DECISIONS}, batch_id bigint").parquet(out)
        return sorted((r["id"], r["headline"], r["batch_id"]) for r in log.collect())

    def arrive(*rows):
        spark.createDataFrame(rows, ARTICLES).coalesce(1).write.mode("append").parquet(inbox)

    arrive(article(1), article(2, age=86400), article(3, age=86401), article(4, title="has one"))
    arrive(article(1), article(5), article(5))
    first = run()
    assert [(n, h) for n, h, _ in first] == [(n, "A good headline here") for n in (1, 2, 5)]
    assert run() == first

    arrive(article(5), article(6), article(7, text=STUCK))
    second = run()
    assert second[:3] == first
    assert [(n, h) for n, h, _ in second[3:]] == [(6, "A good headline here"), (7, None)]

    table = read_articles(spark, inbox).dropDuplicates(["id"])
    log = spark.read.schema(f"{DECISIONS}, batch_id bigint").parquet(out)
    assert headlines(apply_decisions(table, latest_decisions(log))) == {
        1: ("A good headline here", 0), 2: ("A good headline here", 0), 3: (None, None), 4: ("has one", None),
        5: ("A good headline here", 0), 6: ("A good headline here", 0), 7: (None, None),
    }


class Stream:
    """An inbox, a log and a stored table."""

    def __init__(self, spark, folder, model):
        self.spark, self.model = spark, ModelRunner(model)
        self.inbox, self.out, self.checkpoint, self.store = (str(folder / name) for name in ("inbox", "out", "checkpoint", "store"))
        create_store(spark.createDataFrame([], ARTICLES), self.store)

    def arrive(self, *rows):
        self.spark.createDataFrame(rows, ARTICLES).coalesce(1).write.mode("append").parquet(self.inbox)

    def start(self, **how):
        stream = stream_articles(self.spark, self.inbox, files_per_batch=1)
        how = {"store": self.store} | how
        return stream_headlines(stream, self.model, TEMPLATES, self.out, self.checkpoint, as_of=lambda: NOW, **how)

    def run(self, *rows, **how):
        """What the log holds after a run: (batch, id, decided)."""
        if rows:
            self.arrive(*rows)
        self.start(**how).awaitTermination()
        log = self.spark.read.schema(f"{DECISIONS}, batch_id bigint").parquet(self.out)
        return sorted((r["batch_id"], r["id"], r["outcome"] != "error") for r in log.collect())

    def table(self):
        rows = read_store(self.spark, self.store).select("id", "rephrased_title", "headline_verified").collect()
        assert len(rows) == len({r["id"] for r in rows})
        return {r["id"]: (r["rephrased_title"], r["headline_verified"]) for r in rows}


GOOD = ("A good headline here", 0)


def test_stream_retries_what_failed_and_bears_dates_ahead(spark, tmp_path, script, few):
    stream = Stream(spark, tmp_path, script)
    assert stream.run(article(1, age=-10 * 86400), article(7, text=STUCK), article(8, age=10**6)) == [(0, 1, True), (0, 7, False)]
    assert stream.table() == {1: GOOD, 7: (None, None), 8: (None, None)}
    assert stream.run()[2:] == [(1, 7, False)]  # without a new file
    assert stream.run(article(2), article(1), article(8, age=10**6))[3:] == [(2, 2, True), (2, 7, False)]
    assert stream.run(article(7))[5:] == [(3, 7, True)]  # a new arrival takes the place of what failed
    assert stream.run(article(3), article(7))[6:] == [(4, 3, True)]
    assert stream.run() == stream.run()
    assert stream.table() == {1: GOOD, 2: GOOD, 3: GOOD, 7: (None, None), 8: (None, None)} | {7: GOOD}
    rejected = spark.read.parquet(f"{stream.out}/_rejections/batch_id=0")
    assert rejected.columns == ["ts", "id", "stage", "generated", "reason"]


def test_stream_that_goes_on_retries_by_the_clock(spark, tmp_path, script, few):
    stream = Stream(spark, tmp_path, script)
    stream.arrive(article(1), article(7, text=STUCK))
    query = stream.start(trigger_s=0.5, retry_s=1)
    try:
        again = 0
        for _ in range(120):
            time.sleep(0.5)
            log = spark.read.schema(f"{DECISIONS}, batch_id bigint").parquet(stream.out) if (tmp_path / "out").exists() else None
            again = log.filter("id = 7").count() if log is not None else 0
            if again > 1:
                break
        assert again > 1  # no file has come
        assert log.filter("id = 1").count() == 1
    finally:
        query.stop()


@pytest.mark.parametrize("where", ["update_store", "rejections"])
def test_stream_fails_and_is_started_again(spark, tmp_path, script, few, monkeypatch, where):
    """A failure before, or after, the new version of the table is published: the next start makes up for it."""
    stream = Stream(spark, tmp_path, script)
    real = getattr(incremental, where)

    def broken(*args, **how):
        if where == "update_store":
            real(*args, **how)  # published, but the stream does not hear of it
        raise OSError("no more power")

    stream.arrive(article(1), article(2))
    with monkeypatch.context() as patch:
        patch.setattr(incremental, where, broken)
        with pytest.raises(Exception, match="no more power"):
            stream.start().awaitTermination()
    published = where == "update_store"
    assert stream.table() == ({1: GOOD, 2: GOOD} if published else {})
    number = version(spark, stream.store).number
    assert stream.run() == [(0, 1, True), (0, 2, True)]
    assert stream.table() == {1: GOOD, 2: GOOD}
    assert version(spark, stream.store).number == (number if published else 2)
