from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from masthead.operators.candidates import (
    any_unverified,
    audit_candidates,
    generation_candidates,
    headline_state,
    newest,
    newest_per_shard,
    recent,
    shard,
)
from masthead.schema import ARTICLES
from masthead.workload.queries import registered

NOW = 1_700_000_000


def table(spark, rows):
    return spark.createDataFrame(rows, ARTICLES)


def ids(df):
    return sorted(row["id"] for row in df.select("id").collect())


@pytest.fixture(scope="module")
def states(spark):
    titles = [None, "", "  ", "A headline"]
    rows = [
        (n, "t", b"x", NOW, title, flag)
        for n, (title, flag) in enumerate((t, f) for t in titles for f in (None, 0, 1))
    ]
    return table(spark, [*rows, (90, "t", None, NOW, None, None)])


def test_states(states):
    got = {row["id"]: row["state"] for row in states.select("id", headline_state().alias("state")).collect()}
    assert [got[n] for n in range(12)] == (
        ["pending"] * 3 + ["parked"] * 3 + ["unverified", "unverified", "verified"] * 2
    )
    assert got[90] is None


def test_each_job_takes_its_state(states):
    assert ids(generation_candidates(states, NOW, None)) == [0, 1, 2]
    assert ids(audit_candidates(states, NOW, None)) == [6, 7, 9, 10]


def test_window_includes_its_border(spark):
    rows = [(n, "t", b"x", NOW - 86400 + n - 1, None, None) for n in range(3)]
    rows += [(10 + n, "t", b"x", NOW - 259200 + n - 1, "h", 0) for n in range(3)]
    df = table(spark, [*rows, (99, "t", b"x", None, None, None)])
    assert ids(generation_candidates(df, NOW, None)) == [1, 2]
    assert ids(audit_candidates(df, NOW, None)) == [11, 12]


def test_shard(spark):
    df = table(spark, [(n, "t", b"x", NOW, None, None) for n in range(-4, 8)])
    assert ids(shard(df, 4, 3)) == [3, 7]
    assert ids(shard(df, 4, 0)) == [-4, 0, 4]
    assert ids(shard(df, 4, 4)) == []
    assert len(ids(shard(df, 1, 3))) == len(ids(shard(df, 4, None))) == 12


def test_batches_are_the_newest(spark):
    df = table(spark, [(n, "t", b"x", NOW - n // 3, None, None) for n in range(30)])
    assert ids(generation_candidates(df, NOW, 10)) == [0, 1, 2, 3, 4, 5, 6, 7, 8, 11]
    assert len(ids(generation_candidates(df, NOW))) == 30
    assert ids(generation_candidates(df, NOW, 4, shards=2, number=1)) == [1, 3, 5, 7]


@pytest.mark.parametrize("limit", [0, 1, 7, 100, 333, 334, 335, 900, 1000, 11_000, 16_999, 20_000])
def test_batches_of_any_size_follow_the_order(spark, limit):
    """A third of the rows share one second, some have no date, some ids come twice."""
    rows = [(n * 7919 - 3000, NOW - 400 if n % 3 == 0 else NOW - n % 997) for n in range(12_000)]
    rows += [(n % 40, None) for n in range(5_000)]
    rows += [(rows[3][0], NOW - 400)] * 5
    df = spark.createDataFrame(rows, "id bigint, scraped_at bigint")
    ordered = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]), reverse=True)
    got = [(r["id"], r["scraped_at"]) for r in newest(df, limit).collect()]
    assert sorted(got, key=str) == sorted(ordered[:limit], key=str)


def test_all_shards_at_once_equal_one_run_per_shard(spark):
    """One shard holds a third of the rows and more."""
    df = spark.range(600).select(
        F.when(F.col("id") % 3 == 0, F.col("id") * 4).otherwise(F.col("id") * 4 + F.col("id") % 4).alias("id"),
        (NOW - F.col("id") % 50).alias("scraped_at"),
    )
    together = newest_per_shard(df, 4, 20)
    assert "_salt" not in together.columns
    for number in range(4):
        alone = ids(newest(shard(df, 4, number), 20))
        assert ids(together.filter(F.col("shard") == number)) == alone
        ranks = [r["rn"] for r in together.filter(F.col("shard") == number).orderBy("rn").collect()]
        assert ranks == list(range(1, len(alone) + 1))
    assert ids(newest_per_shard(df, 4, 20, salts=1)) == ids(together)


def test_negative_ids_belong_to_no_shard(spark):
    df = spark.createDataFrame([(-5, NOW), (-4, NOW), (3, NOW)], "id bigint, scraped_at bigint")
    assert ids(newest_per_shard(df, 4, 20)) == [3]


def test_any_unverified(states):
    assert any_unverified(states, NOW).first()["has_more"] is True
    assert any_unverified(recent(states, NOW + 10**6, 1), NOW).first()["has_more"] is False
    assert any_unverified(states, NOW + 259201).first()["has_more"] is False


def test_the_large_batch_takes_all_there_is_room_for(spark, tmp_path):
    """More articles than fit into a small batch, fewer than into the large one: all come, with their own dates."""
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("A text.").alias("text"), F.lit("en").alias("lang"), F.lit("web").alias("source"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = {(r["id"], r["scraped_at"]) for r in registered()["newest_many"](spark, str(tmp_path)).collect()}
    assert got == {(n, 1704672000 - n * 7919 % 604800) for n in range(300)}
