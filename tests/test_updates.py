from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from masthead.operators.candidates import recent
from masthead.operators.updates import (
    apply_decisions,
    latest_decisions,
    merge_decisions,
    reject_and_blank,
    rejection_line,
    rejections,
    undecided,
)
from masthead.plans.reports import audit_summary, format_report, generation_summary, outcome_report
from masthead.schema import ARTICLES, DECISIONS
from masthead.sources import sinks
from masthead.sources.articles import read_articles
from masthead.sources.sinks import append_rejection_log, append_rejections, update_articles, write_articles
from masthead.sources.templates import Templates, load_templates

NOW = 1_700_000_000


@pytest.fixture(scope="module")
def articles(spark):
    rows = [
        (1, "t", b"x", NOW, None, None),
        (2, "t", b"x", NOW, "old", 0),
        (3, "t", b"x", NOW, "", 1),
        (4, "t", b"x", NOW - 10**6, "older", None),
        (5, "t", b"x", None, None, None),
        (6, "t", b"x", NOW - 5, "kept", 0),
    ]
    return spark.createDataFrame(rows, ARTICLES)


@pytest.fixture(scope="module")
def decisions(spark):
    rows = [
        (1, "new", 0, "hook", "hook_critic", None, None, []),
        (2, "", 1, "fallback", "safe", "empty headline", None,
         [("hook", "a", "critic answered NO"), ("safe", "", "empty headline")]),
        (6, None, None, "error", "hook", None, "RuntimeError: x", []),
        (77, "nobody", 0, "hook", "hook_critic", None, None, []),
    ]
    return spark.createDataFrame(rows, DECISIONS)


def headlines(df):
    return {row["id"]: (row["rephrased_title"], row["headline_verified"]) for row in df.collect()}


EXPECTED = {
    1: ("new", 0),
    2: ("", 1),
    3: ("", 1),
    4: ("older", None),
    5: (None, None),
    6: ("kept", 0),
}


@pytest.mark.parametrize("since", [None, NOW - 100])
@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_apply(spark, articles, decisions, since, threshold):
    """NULL, empty and unknown are told apart, whichever way the join is done."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        updated = apply_decisions(articles, decisions, since)
        assert updated.columns == articles.columns
        assert headlines(updated) == EXPECTED
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_apply_twice_changes_nothing(articles, decisions):
    assert headlines(apply_decisions(apply_decisions(articles, decisions), decisions)) == EXPECTED


def test_undecided(articles, decisions):
    assert sorted(row["id"] for row in undecided(articles, decisions).collect()) == [3, 4, 5, 6]


def test_last_decision_wins(spark, decisions):
    log = decisions.withColumn("batch_id", F.lit(0)).unionByName(
        decisions.filter("id = 1").withColumn("headline", F.lit("newer")).withColumn("batch_id", F.lit(3))
    )
    last = {row["id"]: row["headline"] for row in latest_decisions(log).collect()}
    assert last == {1: "newer", 2: "", 77: "nobody"}


def test_rejections(spark, decisions, tmp_path):
    ts = F.timestamp_seconds(F.lit(NOW))
    rejected = rejections(decisions, ts)
    assert rejected.columns == ["ts", "id", "stage", "generated", "reason"]
    lines = sorted(row[0] for row in rejected.select(rejection_line(F.col("ts"))).collect())
    assert lines == [
        "[2023-11-14 22:13:20] Article ID: 2 | Stage: hook | Generated: 'a' | Reason: critic answered NO",
        "[2023-11-14 22:13:20] Article ID: 2 | Stage: safe | Generated: '' | Reason: empty headline",
    ]
    for _ in range(2):
        append_rejections(rejected, str(tmp_path / "table"))
        append_rejection_log(rejected, str(tmp_path / "log"))
    table = spark.read.parquet(str(tmp_path / "table"))
    assert table.count() == 4
    assert {str(row["run_date"]) for row in table.collect()} == {"2023-11-14"}
    assert sorted(row[0] for row in spark.read.text(str(tmp_path / "log")).collect()) == sorted(lines * 2)


def test_reject_and_blank(articles, decisions):
    rejected = rejections(decisions)
    assert headlines(reject_and_blank(articles, rejected)) == headlines(articles) | {2: ("", 0)}
    assert headlines(reject_and_blank(articles, rejected, dry_run=True)) == headlines(articles)


def test_merge_needs_a_table_that_can(spark, decisions):
    decisions.createOrReplaceTempView("no_row_level_changes")
    with pytest.raises(PySparkException):
        merge_decisions(decisions, "no_row_level_changes")


def test_generation_summary(spark, decisions):
    assert generation_summary(decisions, 4).first().asDict() == {
        "loaded": 4, "processed": 2, "fallback": 1, "errors": 1, "has_more": True,
    }
    assert generation_summary(decisions).first()["has_more"] is False
    assert generation_summary(decisions, None).first()["has_more"] is False
    nothing = generation_summary(decisions.limit(0)).first()
    assert (nothing["loaded"], nothing["has_more"]) == (0, False)


def test_audit_summary(spark, articles):
    def summary(*outcomes):
        rows = [
            (n, "h", None if o == "error" else 1, o, "critic", None, None, []) for n, o in outcomes
        ]
        decisions = spark.createDataFrame(rows, DECISIONS)
        updated = apply_decisions(articles, decisions)
        return audit_summary(decisions, updated, NOW).first().asDict()

    done = summary((2, "validated"), (6, "fallback"))
    assert done == {"loaded": 2, "validated": 1, "fixed": 1, "llm_failures": 0, "has_more": False}
    assert summary((2, "validated"), (6, "error"))["has_more"] is True
    assert summary((2, "fixed"))["has_more"] is True
    stuck = summary((2, "error"), (6, "error"))
    assert (stuck["llm_failures"], stuck["has_more"]) == (2, False)
    assert summary()["has_more"] is False


def test_reports(spark, decisions):
    counts = {(r["stage"], r["outcome"]): r["n"] for r in outcome_report(decisions).collect()}
    assert counts == {("hook_critic", "hook"): 2, ("safe", "fallback"): 1, ("hook", "error"): 1}
    df = spark.createDataFrame(
        [("en", "a b c"), (None, "a b c"), ("en", "a b"), ("de", "w " * 15), ("de", "w " * 16), ("de", "")],
        "lang string, h string",
    )
    got = {(r["level"], r["lang"], r["reason"]): r["n"] for r in format_report(df, "h", "lang").collect()}
    assert got == {
        (0, "en", "valid"): 1, (0, None, "valid"): 1, (1, None, "valid"): 2,
        (0, "en", "too short"): 1, (1, None, "too short"): 1,
        (0, "de", "length exceeds 14 words"): 2, (1, None, "length exceeds 14 words"): 2,
        (0, "de", "empty headline"): 1, (1, None, "empty headline"): 1,
    }
    assert {r["reason"]: r["n"] for r in format_report(df, "h").collect()}["valid"] == 2


def test_articles_are_read_as_written(spark, articles, tmp_path):
    write_articles(articles, str(tmp_path / "parquet"))
    articles.write.orc(str(tmp_path / "orc"))
    for form in ("parquet", "orc"):
        assert headlines(read_articles(spark, str(tmp_path / form), form)) == headlines(articles)
    articles.createOrReplaceTempView("some_articles")
    assert headlines(read_articles(spark, "some_articles", "table")) == headlines(articles)


def test_update_replaces_only_the_days_of_the_window(spark, articles, decisions, tmp_path):
    path = str(tmp_path / "store")
    write_articles(articles, path)

    def files():
        return {f.relative_to(tmp_path) for f in (tmp_path / "store").rglob("*.parquet")}

    before = files()
    for _ in range(2):
        update_articles(spark, path, decisions, NOW - 86400)
        assert headlines(read_articles(spark, path)) == EXPECTED
    kept = before & files()
    today = f"scraped_day={NOW // 86400}"
    assert {f.parts[1] for f in kept} == {f.parts[1] for f in before} - {today}
    assert len({f.parts[1] for f in before}) == 3


def test_recent_days_only_are_scanned(spark, articles, tmp_path):
    write_articles(articles, str(tmp_path / "store"))
    stored = read_articles(spark, str(tmp_path / "store"))
    found = recent(stored, NOW, 86400)
    assert sorted(row["id"] for row in found.collect()) == [1, 2, 3, 6]
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "(scraped_day#" in text.split("PartitionFilters")[1].split("]")[0]


def test_templates(spark, tmp_path):
    packaged = load_templates()
    assert packaged.hook.count("{body_snippet}") == packaged.safe.count("{body_snippet}") == 1
    assert packaged.critic.index("{body_snippet}") < packaged.critic.index("{headline}")
    for name in ("hook", "safe"):
        (tmp_path / f"{name}.txt").write_text(f"{name}\n{{body_snippet}} é", "utf-8")
    with pytest.raises(PySparkException):
        load_templates(spark, str(tmp_path))
    (tmp_path / "critic.txt").write_text("{headline}{body_snippet}", "utf-8")
    own = load_templates(spark, str(tmp_path))
    assert own == Templates("hook\n{body_snippet} é", "safe\n{body_snippet} é", "{headline}{body_snippet}")
    (tmp_path / "hook.txt").write_text("no slot", "utf-8")
    with pytest.raises(ValueError, match="hook"):
        load_templates(spark, str(tmp_path))


def _store(spark, tmp_path):
    """Four days with three articles each, ids 0 to 11."""
    path = str(tmp_path / "days")
    rows = [(n, "t", b"x", NOW - 86400 * (n // 3), None, None) for n in range(12)]
    write_articles(spark.createDataFrame(rows, ARTICLES), path)
    return path


def _files(path):
    from pathlib import Path

    return {str(p.relative_to(path)) for p in Path(path).rglob("*.parquet")}


def test_one_decision_replaces_one_day(spark, tmp_path):
    path = _store(spark, tmp_path)
    before = _files(path)
    decision = spark.createDataFrame([(4, "new", 0, "hook", "hook_critic", None, None, [])], DECISIONS)
    update_articles(spark, path, decision, NOW - 10 * 86400)
    assert len({name.split("/")[0] for name in before - _files(path)}) == 1
    assert headlines(read_articles(spark, path)) == {n: ("new", 0) if n == 4 else (None, None) for n in range(12)}
    after = _files(path)
    update_articles(spark, path, decision.withColumn("outcome", F.lit("error")), NOW - 10 * 86400)
    assert _files(path) == after


def test_a_failed_update_keeps_the_staged_days(spark, tmp_path, monkeypatch):
    path = _store(spark, tmp_path)
    decision = spark.createDataFrame([(4, "new", 0, "hook", "hook_critic", None, None, [])], DECISIONS)

    def failing(updated, path):
        raise OSError("disk gone")

    with monkeypatch.context() as patched, pytest.raises(OSError, match="disk gone") as caught:
        patched.setattr(sinks, "replace_days", failing)
        update_articles(spark, path, decision, NOW - 10 * 86400)
    staged = caught.value.__notes__[0].split(" in ")[1]
    for _ in range(2):
        sinks.replace_days(spark.read.parquet(staged), path)
        assert headlines(read_articles(spark, path)) == {n: ("new", 0) if n == 4 else (None, None) for n in range(12)}


def test_updates_of_a_window_read_its_days_only(spark, tmp_path, decisions):
    table = read_articles(spark, _store(spark, tmp_path))
    for updated in (
        apply_decisions(table, decisions, NOW - 86400),
        reject_and_blank(table, decisions.select("id"), since=NOW - 86400),
    ):
        text = updated._jdf.queryExecution().executedPlan().toString()
        assert text.count("PartitionFilters: [isnotnull(scraped_day") >= 1
        assert "(scraped_day" in text and "<= " in text
        assert updated.count() == 12
