"""Generation cascade: hook, critic, safe, critic, lead headline.

Each model call is one stage over the rows that still need it, and its result is staged. Rows leave the funnel
as soon as they are decided, and the decisions are the union of what left at each stage: there is no join
and no shuffle by key. A row any step fails on is reported with its error and stays pending.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from masthead.functions.clean import with_clean_headline
from masthead.functions.payload import SNIPPET_CHARS
from masthead.functions.prompt import render
from masthead.functions.validate import EMPTY, with_format_reason
from masthead.operators.decisions import (
    attempt,
    attempts,
    decide,
    first_call,
    refusal,
    union_all,
)
from masthead.operators.inference import HOOK_CALL, SAFE_CALL, ModelRunner
from masthead.sources.staging import Staging
from masthead.sources.templates import Templates


def _checked(judged: DataFrame, source: str) -> DataFrame:
    """Add ``clean`` and ``doubt``, the cleaned text and what is wrong with its format."""
    cleaned = with_clean_headline(judged.withColumn("_raw", F.col(source)["text"]), "_raw", "clean")
    return with_format_reason(cleaned, "clean", "doubt").drop("_raw")


def generate_headlines(
    candidates: DataFrame,
    model: ModelRunner,
    templates: Templates,
    staging: Staging,
    snippet_chars: int | None = SNIPPET_CHARS,
) -> DataFrame:
    """One decision per candidate (``id, title, rephrased_article``).

    A critic judges the text as the model wrote it; cleaning and the format check follow. An article without a
    title is an error. Prompts show the first ``snippet_chars`` characters of an article, or with None all of it.
    """
    inputs = candidates.select("id", "rephrased_article", F.col("title").isNotNull().alias("titled"))
    prompt = F.when(F.col("titled"), render(templates.hook, body_snippet=F.col("snippet")))
    answered = first_call(inputs, model, staging, snippet_chars, lambda a: model.generate(a, prompt, HOOK_CALL, "hook"))
    hooked = staging.save(answered, "hook")
    hook = F.col("hook")
    written = hook["error"].isNull() & (hook["text"] != "")

    critic, clean, doubt = F.col("critic"), F.col("clean"), F.col("doubt")
    failed = critic["error"].isNotNull()
    approved = ~failed & critic["approved"]
    refused = ~failed & ~critic["approved"]
    judged = model.critique(model.spread(hooked.filter(written), "chars"), templates.critic, hook["text"], "critic")
    judged = staging.save(_checked(judged, "hook"), "hook_critic")

    # Everything without an approved hook gets a second, safer text.
    empty = hooked.filter(hook["error"].isNull() & (hook["text"] == "")).withColumn(
        "first", attempt("hook", hook["text"], F.lit(EMPTY))
    )
    wrong = judged.filter(refused).withColumn("first", attempt("hook", hook["text"], refusal(critic)))
    retry = union_all([part.select("id", "snippet", "chars", "lead", "cause", "first") for part in (empty, wrong)])
    prompt = render(templates.safe, body_snippet=F.col("snippet"))
    retried = staging.save(model.generate(model.spread(retry, "chars"), prompt, SAFE_CALL, "safe"), "safe")
    safe, first = F.col("safe"), F.col("first")
    rewritten = safe["error"].isNull() & (safe["text"] != "")

    rewrites = model.spread(retried.filter(rewritten), "chars")
    rejudged = model.critique(rewrites, templates.critic, safe["text"], "critic")
    rejudged = staging.save(_checked(rejudged.drop("snippet"), "safe"), "safe_critic")

    # What leaves the funnel at each stage.
    lead, error = F.col("lead"), F.lit("error")
    good = approved & doubt.isNull()
    headline = F.when(good, clean).when(~failed, lead)
    verified = F.when(good, 0).when(~failed, 1)
    misshapen = attempt("format", clean, F.when(approved, doubt))
    rejected = refusal(critic)
    return union_all(
        [
            decide(
                hooked.filter(~F.col("titled") | hook["error"].isNotNull()),
                outcome=error,
                stage=F.when(F.col("titled"), "hook").otherwise("load"),
                error=F.coalesce(hook["error"], F.lit("article has no title")),
            ),
            decide(
                judged.filter(~refused),
                outcome=F.when(failed, error).when(doubt.isNull(), "hook").otherwise("format_fallback"),
                headline=headline,
                verified=verified,
                stage="hook_critic",
                reason=F.when(approved, doubt),
                error=critic["error"],
                tried=attempts(misshapen),
            ),
            decide(
                retried.filter(~rewritten),
                outcome=F.when(safe["error"].isNotNull(), error).otherwise("fallback"),
                headline=F.when(safe["error"].isNull(), lead),
                verified=F.when(safe["error"].isNull(), 1),
                stage="safe",
                reason=F.when(safe["error"].isNull(), EMPTY),
                error=safe["error"],
                tried=attempts(first, attempt("safe", safe["text"], F.when(safe["error"].isNull(), EMPTY))),
            ),
            decide(
                rejudged,
                outcome=F.when(failed, error)
                .when(refused, "fallback")
                .when(doubt.isNull(), "safe")
                .otherwise("format_fallback"),
                headline=headline,
                verified=verified,
                stage="safe_critic",
                reason=F.coalesce(rejected, F.when(approved, doubt)),
                error=critic["error"],
                tried=attempts(first, attempt("safe", safe["text"], rejected), misshapen),
            ),
        ]
    )
