"""The stored table with several writers: versions are seen whole, nothing is lost, replays change nothing."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pytest

from masthead.schema import ARTICLES, DECISIONS
from masthead.sources import store
from masthead.sources.store import TooManyWriters, create_store, expire, is_store, read_store, update_store, version

DAY = 86400
NOW = 20000 * DAY


def articles(spark, ids, age=lambda n: (n % 3) * DAY):
    rows = [(n, f"title {n}", b"x", None if age(n) is None else NOW - age(n), None, None) for n in ids]
    return spark.createDataFrame(rows, ARTICLES)


def decided(spark, ids, text="headline"):
    return spark.createDataFrame([(n, f"{text} {n}", 0, "hook", "hook_critic", None, None, []) for n in ids], DECISIONS)


def titles(spark, path, **how):
    rows = read_store(spark, path, **how).select("id", "rephrased_title").collect()
    assert len(rows) == len({r[0] for r in rows})
    return {n: t for n, t in rows}


@pytest.fixture
def path(spark, tmp_path):
    create_store(articles(spark, range(12)), str(tmp_path / "store"))
    return str(tmp_path / "store")


def test_create_and_read(spark, tmp_path, path):
    assert is_store(spark, path) and not is_store(spark, str(tmp_path / "other"))
    assert titles(spark, path) == dict.fromkeys(range(12))
    assert set(titles(spark, path, since=NOW)) == {0, 3, 6, 9}
    with pytest.raises(ValueError, match="there is a stored table"):
        create_store(articles(spark, [1]), path)
    empty = str(tmp_path / "empty")
    create_store(articles(spark, []), empty)
    assert titles(spark, empty) == {}
    update_store(spark, empty, arrivals=articles(spark, [1, 2], age=lambda n: None if n == 1 else 0))
    assert titles(spark, empty) == {1: None, 2: None}  # also without a date


def test_update_replaces_only_days_with_a_decision(spark, path):
    before = version(spark, path)
    old = read_store(spark, path)
    after = update_store(spark, path, decided(spark, [1, 4, 99]), since=NOW - 2 * DAY)
    assert {d for d in after.days if after.days[d] != before.days[d]} == {str(20000 - 1)}
    assert titles(spark, path) == dict.fromkeys(range(12)) | {1: "headline 1", 4: "headline 4"}
    assert titles(spark, path, number=1) == dict.fromkeys(range(12))
    assert old.filter("rephrased_title is not null").count() == 0  # a reader stays at its version
    assert update_store(spark, path, decided(spark, [99])).number == after.number  # nothing to write


def test_window_bounds_what_is_searched(spark, path):
    update_store(spark, path, decided(spark, range(12)), since=NOW - DAY)
    assert {n for n, t in titles(spark, path).items() if t} == {n for n in range(12) if n % 3 < 2}


def test_arrivals_are_added_once(spark, path):
    coming = articles(spark, [3, 100, 101], age=lambda n: 0 if n != 101 else 9 * DAY)
    update_store(spark, path, decided(spark, [100]), since=NOW, arrivals=coming, source="stream", batch=0)
    want = dict.fromkeys([*range(12), 101]) | {100: "headline 100"}
    assert titles(spark, path) == want
    update_store(spark, path, arrivals=coming, source="stream", batch=1)
    assert titles(spark, path) == want


def test_a_replay_changes_nothing(spark, path):
    first = update_store(spark, path, decided(spark, [1]), source="stream", batch=4)
    update_store(spark, path, decided(spark, [1], "later"), source="other", batch=0)
    again = update_store(spark, path, decided(spark, [1]), source="stream", batch=4)
    assert (first.number, again.number) == (2, 3)
    assert titles(spark, path)[1] == "later 1"


def test_failing_before_publishing_changes_nothing(spark, path, monkeypatch):
    def broken(*_):
        raise OSError("no more power")

    with monkeypatch.context() as patch:
        patch.setattr(store, "_publish", broken)
        with pytest.raises(OSError, match="no more power"):
            update_store(spark, path, decided(spark, [1, 2]), source="stream", batch=0)
    assert version(spark, path).number == 1 and titles(spark, path) == dict.fromkeys(range(12))
    update_store(spark, path, decided(spark, [1, 2]), source="stream", batch=0)
    assert {n for n, t in titles(spark, path).items() if t} == {1, 2}
    assert expire(spark, path, kept=1, grace_s=-60) == 4  # the days of the failed attempt, and those that were replaced
    assert {n for n, t in titles(spark, path).items() if t} == {1, 2}
    assert expire(spark, path, kept=1, grace_s=-60) == 0


def test_an_overtaken_writer_rewrites_only_what_the_other_changed(spark, path, monkeypatch):
    real, calls = store._changed, []

    def overtaken(spark_, path_, base, decisions, since, arrivals, only):
        calls.append(only)
        found = real(spark_, path_, base, decisions, since, arrivals, only)
        if len(calls) == 1:  # somebody else is faster
            update_store(spark_, path_, decided(spark_, [4, 7], "other"))
        return found

    monkeypatch.setattr(store, "_changed", overtaken)
    update_store(spark, path, decided(spark, [0, 1, 2]))
    assert calls == [None, None, {"19999"}]
    assert titles(spark, path) == dict.fromkeys(range(12)) | {0: "headline 0", 1: "headline 1", 2: "headline 2", 4: "other 4", 7: "other 7"}


def test_writers_side_by_side_lose_nothing(spark, path):
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: update_store(spark, path, decided(spark, [k, k + 4, k + 8])), range(4)))
    assert titles(spark, path) == {n: f"headline {n}" for n in range(12)}
    assert version(spark, path).number == 5


def test_giving_up(spark, path, monkeypatch):
    monkeypatch.setattr(store, "_publish", lambda *_: False)
    with pytest.raises(TooManyWriters):
        update_store(spark, path, decided(spark, [1]), attempts=3)
