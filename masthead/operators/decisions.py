"""Shared pieces of the two cascades."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from masthead.functions.lead import with_lead_headline
from masthead.functions.payload import SNIPPET_CHARS, snippet, with_content
from masthead.operators.inference import ModelRunner
from masthead.schema import ATTEMPT, DECISION_COLUMNS
from masthead.sources.staging import Staging

LOAD = "load"
UNREADABLE = "unreadable text: "


def with_snippet(df: DataFrame, chars: int | None = SNIPPET_CHARS) -> DataFrame:
    """Replace the packed text by ``content`` and by the ``snippet`` the prompts show: its first ``chars`` characters, or all. ``cause``
    says why a text could not be read; such an article goes on without text, and its decision names the cause as an attempt.
    ``chars`` is the length of the snippet."""
    shown = with_content(df).drop("corrupt").withColumn("snippet", snippet(F.col("content"), chars))
    return shown.withColumn("chars", F.length("snippet"))


def with_lead(answered: DataFrame) -> DataFrame:
    """Replace the text by the ``lead`` headline, for use should nothing pass; the text goes no further.

    To be called behind a model call of the same stage, if it has one: the optimizer folds all projections below a
    Python call into one expression, which for these rules grows beyond any use.
    """
    return with_lead_headline(answered, "content", "lead").drop("content")


def first_call(
    inputs: DataFrame, model: ModelRunner, staging: Staging, chars: int | None, call: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Unpack the articles, ``call`` the model on them, and give them their lead headlines.

    Prompts are as long as their texts, so a model dealt by work sees articles that were unpacked and staged before; what is not
    in the prompt stops there. Otherwise all of it is one stage."""
    if model.by_work:
        opened = staging.save(with_lead(with_snippet(inputs, chars)), "opened")
        return call(model.spread(opened, "chars"))
    return with_lead(call(with_snippet(model.spread(inputs), chars)))


def attempt(stage: str, generated: Column, reason: Column) -> Column:
    """A rejected text, or NULL where there is no reason to reject it."""
    fields = F.struct(F.lit(stage).alias("stage"), generated.alias("generated"), reason.alias("reason"))
    return F.when(reason.isNotNull(), fields).cast(ATTEMPT)


def attempts(*tried: Column) -> Column:
    """The rejected texts in order."""
    return F.array_compact(F.array(*tried))


def refusal(critic: Column) -> Column:
    """Why the critic's answer is no approval, or NULL if it is one or the call failed."""
    said = F.when(critic["answer"] == "", "[empty]").otherwise(F.upper(critic["answer"]))
    return F.when(critic["error"].isNull() & ~critic["approved"], F.concat(F.lit("critic answered "), said))


def decide(
    df: DataFrame,
    outcome: Column,
    stage: Column | str,
    headline: Column | None = None,
    verified: Column | None = None,
    reason: Column | None = None,
    error: Column | None = None,
    tried: Column | None = None,
) -> DataFrame:
    """Bring rows that are decided into the shape of the decisions table. An unreadable text (``cause``) is the first of the attempts."""
    null = F.lit(None)
    tried = F.array() if tried is None else tried
    if "cause" in df.columns:
        load = attempt(LOAD, F.lit(""), F.concat(F.lit(UNREADABLE), F.col("cause")))
        tried = F.concat(attempts(load), tried.cast(f"array<{ATTEMPT}>"))
    values = [
        F.col("id"),
        (null if headline is None else headline).cast("string"),
        (null if verified is None else verified).cast("int"),
        outcome,
        F.lit(stage),
        (null if reason is None else reason).cast("string"),
        (null if error is None else error).cast("string"),
        tried.cast(f"array<{ATTEMPT}>"),
    ]
    return df.select(*[v.alias(name) for v, name in zip(values, DECISION_COLUMNS, strict=True)])


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def quarantined(decisions: DataFrame, articles: DataFrame) -> DataFrame:
    """``id, cause, rephrased_article`` of the decided articles whose text could not be read."""
    bad = decisions.select("id", F.get("attempts", F.lit(0)).alias("first"))
    bad = bad.filter((F.col("first.stage") == LOAD) & F.col("first.reason").startswith(UNREADABLE))
    cause = F.substring("first.reason", len(UNREADABLE) + 1, 100)
    return bad.select("id", cause.alias("cause")).join(articles.select("id", "rephrased_article"), "id")
