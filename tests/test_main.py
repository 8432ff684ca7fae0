from __future__ import annotations

import pytest

from masthead.main import arguments, run
from masthead.sources.sinks import write_articles
from masthead.sources.store import create_store, read_store
from masthead.workload.inputs import AS_OF, articles


def parse(*extra, job="generate"):
    return arguments([job, "--articles", "a", "--out", "o", "--model", "m:f", *extra])


@pytest.mark.parametrize(
    ("args", "expected"),
    [(parse(), None), (parse("--batch-size", "7"), 7), (parse(job="audit"), None), (parse("--batch-size", "3", job="audit"), 3)],
)
def test_batch_size(args, expected):
    assert args.batch_size == expected


def test_one_shard_or_all():
    with pytest.raises(SystemExit):
        parse("--all-shards", "--num-shards", "4", "--shard", "1")


def test_shards_share_a_versioned_store_only(spark, tmp_path):
    plain, versioned = str(tmp_path / "plain"), str(tmp_path / "versioned")
    table = articles(spark, "/root/testdata/sf0.001")
    write_articles(table, plain)
    create_store(table, versioned)

    def one(store, *extra):
        return run(
            spark,
            arguments(
                ["generate", "--articles", store, "--out", str(tmp_path / "-".join(extra)), "--as-of", str(AS_OF), "--in-place",
                 "--model", "masthead.workload.standin:standin", "--num-shards", "2", *extra]
            ),
        )

    with pytest.raises(ValueError, match="undo each other"):
        one(plain, "--shard", "1")
    first = one(versioned, "--shard", "1").summary.first()["loaded"]
    by_shard = {r["shard"]: r.asDict() for r in one(versioned, "--all-shards", "--batch-size", "2").summary.collect()}
    assert first > 0 and by_shard[0]["loaded"] == 2 and by_shard[0]["has_more"]
    assert by_shard[1]["loaded"] == by_shard[1]["errors"]  # what failed is still there
    assert read_store(spark, versioned).filter("rephrased_title is not null").count() > table.filter("rephrased_title is not null").count() + 2


def test_both_jobs_in_place(spark, tmp_path):
    store = str(tmp_path / "store")
    write_articles(articles(spark, "/root/testdata/sf0.001"), store)
    for job in ("generate", "audit"):
        args = arguments(
            [job, "--articles", store, "--out", str(tmp_path / job), "--as-of", str(AS_OF), "--in-place",
             "--model", "masthead.workload.standin:standin", "--model-partitions", "3"]
        )
        summary = run(spark, args).summary.first()
        assert summary["loaded"] > 0
    assert spark.read.parquet(store).count() == 200
