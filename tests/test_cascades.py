"""Every row of the two decision tables, through a scripted model."""

from __future__ import annotations

import zlib
from collections import Counter

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from masthead.operators.audit import audit_headlines
from masthead.operators.generation import generate_headlines
from masthead.operators.inference import CallOptions, ModelRunner
from masthead.operators.updates import rejections
from masthead.schema import DECISIONS
from masthead.sources.staging import Staging
from tests import scripted
from tests.scripted import TEMPLATES, Script

cloudpickle.register_pickle_by_value(scripted)

GOOD = "good headline with words"
SAFE = "safe headline with words"
LONG = " ".join("long" for _ in range(15))
LEAD = "HOOKED"

# script, headline, verified, outcome, stage, reason, error, rejected texts
GENERATION = {
    "hook passes": (f"{GOOD}|!|{GOOD}", "Good headline with words", 0, "hook", "hook_critic", None, None, []),
    "hook is cleaned after the critic": (
        f'"{GOOD}."|!|"{GOOD}."', "Good headline with words", 0, "hook", "hook_critic", None, None, [],
    ),
    "hook refused, safe passes": (
        f"{GOOD}|{SAFE}|{SAFE}", "Safe headline with words", 0, "safe", "safe_critic", None, None,
        [("hook", GOOD, "critic answered NO.")],
    ),
    "hook empty, safe passes": (
        f" |{SAFE}|{SAFE}", "Safe headline with words", 0, "safe", "safe_critic", None, None,
        [("hook", "", "empty headline")],
    ),
    "hook missing, safe passes": (
        f"~|{SAFE}|{SAFE}", "Safe headline with words", 0, "safe", "safe_critic", None, None,
        [("hook", "", "empty headline")],
    ),
    "both refused": (
        f"{GOOD}|{SAFE}|none", None, 1, "fallback", "safe_critic", "critic answered NO.", None,
        [("hook", GOOD, "critic answered NO."), ("safe", SAFE, "critic answered NO.")],
    ),
    "hook refused, safe empty": (
        f"{GOOD}||none", None, 1, "fallback", "safe", "empty headline", None,
        [("hook", GOOD, "critic answered NO."), ("safe", "", "empty headline")],
    ),
    "hook approved but too long, safe is not tried": (
        f"{LONG}|{SAFE}|{LONG},{SAFE}", None, 1, "format_fallback", "hook_critic", "length 15 exceeds 14 words",
        None, [("format", LONG.capitalize(), "length 15 exceeds 14 words")],
    ),
    "safe approved but too short": (
        "|two words|two words", None, 1, "format_fallback", "safe_critic", "too short", None,
        [("hook", "", "empty headline"), ("format", "Two words", "too short")],
    ),
    "hook fails": (f"!|{SAFE}|{SAFE}", None, None, "error", "hook", None, "RuntimeError: model down", []),
    "critic fails": (
        f"{GOOD}|{SAFE}|!", None, None, "error", "hook_critic", None, "RuntimeError: critic down", [],
    ),
    "safe fails": (
        f"{GOOD}|!|none", None, None, "error", "safe", None, "RuntimeError: model down",
        [("hook", GOOD, "critic answered NO.")],
    ),
    "second critic fails": (
        f"|{SAFE}|!", None, None, "error", "safe_critic", None, "RuntimeError: critic down",
        [("hook", "", "empty headline")],
    ),
}

# published headline, script, then as above
AUDIT = {
    "approved": ("Old headline", "|!|Old headline", "Old headline", 1, "validated", "critic", None, None, []),
    "approved as it is, however bad": ("*x*", "|!|*x*", "*x*", 1, "validated", "critic", None, None, []),
    "repaired, cleaned before the critic": (
        "Old headline", f'|"{SAFE}."|Safe headline with words', "Safe headline with words", 1, "fixed",
        "repair_critic", None, None, [("published", "Old headline", "critic answered NO.")],
    ),
    "repair refused": (
        "Old headline", f"|{SAFE}|none", None, 1, "fallback", "repair_critic", "critic answered NO.", None,
        [("published", "Old headline", "critic answered NO."),
         ("repair", "Safe headline with words", "critic answered NO.")],
    ),
    "repair badly formed": (
        "Old headline", "|two words|Two words", None, 1, "fallback", "repair", "too short", None,
        [("published", "Old headline", "critic answered NO."), ("repair", "Two words", "too short")],
    ),
    "repair empty": (
        "Old headline", "||", None, 1, "fallback", "repair", "empty headline", None,
        [("published", "Old headline", "critic answered NO."), ("repair", "", "empty headline")],
    ),
    "repair changes nothing": (
        "Safe headline with words", f"|{SAFE}|none", None, 1, "fallback", "repair",
        "same as the refused headline", None,
        [("published", "Safe headline with words", "critic answered NO."),
         ("repair", "Safe headline with words", "same as the refused headline")],
    ),
    "critic fails": (
        "Old headline", f"|{SAFE}|!", None, None, "error", "critic", None, "RuntimeError: critic down", [],
    ),
    "repair fails": (
        "Old headline", "|!|none", None, None, "error", "repair", None, "RuntimeError: model down",
        [("published", "Old headline", "critic answered NO.")],
    ),
}


def packed(script: str) -> bytes:
    """The script as article text: one sentence, so that the lead headline is the whole of it."""
    return zlib.compress(script.encode())


def lead_of(script: str) -> str:
    words = script.replace("*", "").split()
    text = " ".join(words[:12] if len(words) > 14 else words).rstrip(".,;: ")
    return text[:1].upper() + text[1:]


def check(cases, decisions):
    rows = {row["id"]: row for row in decisions.collect()}
    assert sorted(rows) == list(range(len(cases)))
    for n, (name, case) in enumerate(cases.items()):
        script, headline, verified, outcome, stage, reason, error, rejected = case
        row = rows[n]
        got = tuple(row[c] for c in ("verified", "outcome", "stage", "reason", "error"))
        assert got == (verified, outcome, stage, reason, error), name
        assert [tuple(a) for a in row["attempts"]] == rejected, name
        if "fallback" in outcome:
            assert row["headline"], name
            assert row["headline"].split()[0] == lead_of(script).split()[0], name
        else:
            assert row["headline"] == headline, name


@pytest.fixture
def script(tmp_path):
    return Script(str(tmp_path))


def run_generation(spark, script, batch=64, partitions=None, rows_per_task=None):
    rows = [(n, "title", packed(case[0])) for n, case in enumerate(GENERATION.values())]
    df = spark.createDataFrame(rows, "id bigint, title string, rephrased_article binary")
    return generate_headlines(df, ModelRunner(script, batch, partitions, rows_per_task), TEMPLATES, Staging(spark))


def test_generation(spark, script):
    decisions = run_generation(spark, script)
    check(GENERATION, decisions)
    assert decisions.schema.simpleString() == spark.createDataFrame([], DECISIONS).schema.simpleString()


@pytest.mark.parametrize(("batch", "partitions", "rows_per_task"), [(1, 3, None), (1000, 1, None), (3, None, 4)])
def test_generation_does_not_depend_on_batching(spark, script, batch, partitions, rows_per_task):
    check(GENERATION, run_generation(spark, script, batch, partitions, rows_per_task))


def test_generation_asks_the_model_no_more_than_needed(spark, script):
    decisions = run_generation(spark, script, batch=1)
    for _ in range(2):
        decisions.count()
    rejections(decisions).count()
    # Failed calls are not noted: one hook, one safe, two critics.
    assert Counter(script.calls()) == {"HOOK 50 0.4": 12, "SAFE 50 0.2": 7, "CRITIC 5 0.0": 7 + 5}


def test_audit(spark, script):
    rows = [(n, case[0], packed(case[1])) for n, case in enumerate(AUDIT.values())]
    df = spark.createDataFrame(rows, "id bigint, rephrased_title string, rephrased_article binary")
    decisions = audit_headlines(df, ModelRunner(script, 1), TEMPLATES, Staging(spark))
    check({name: case[1:] for name, case in AUDIT.items()}, decisions)
    # Three repairs are not worth a second critic call.
    assert Counter(script.calls()) == {"CRITIC 5 0.0": 8 + 2, "SAFE 50 0.0": 5}


def test_article_without_title_or_text(spark, script):
    rows = [(1, None, packed(f"{GOOD}|x|{GOOD}")), (2, "t", b"junk"), (3, "t", b"")]
    df = spark.createDataFrame(rows, "id bigint, title string, rephrased_article binary")
    templates = type(TEMPLATES)("HOOK|{body_snippet}||", "SAFE|{body_snippet}||", "CRITIC|{body_snippet}||no|{headline}")
    decisions = generate_headlines(df, ModelRunner(script), templates, Staging(spark))
    rows = {row["id"]: row for row in decisions.collect()}
    assert (rows[1]["outcome"], rows[1]["error"]) == ("error", "article has no title")
    for n in (2, 3):
        assert (rows[n]["outcome"], rows[n]["headline"], rows[n]["verified"]) == ("fallback", "", 1)
    assert script.calls() == ["HOOK 50 0.4"] * 2 + ["SAFE 50 0.2"] * 2


def test_wrong_number_of_texts_is_an_error(spark):
    def factory():
        return lambda prompts, options: ["one too many"] * (len(prompts) + 1)

    df = spark.createDataFrame([(1, "p"), (2, "q"), (3, None)], "id bigint, p string")
    answers = ModelRunner(factory).generate(df, F.col("p"), CallOptions(5, 0.0), "a")
    rows = {row["id"]: row["a"] for row in answers.collect()}
    assert rows[1]["error"] == rows[2]["error"] == "ValueError: model gave 2 texts for 1 prompts"
    assert rows[3] == (None, None)
