"""Audit and repair cascade: critic on the published headline, then a safe text, a format check, and a second
critic for those texts that the cheap checks let through.

Staged like the generation cascade: every model call runs only over the rows that need it, and rows leave
the funnel as soon as they are decided.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from masthead.functions.clean import with_clean_headline
from masthead.functions.payload import SNIPPET_CHARS
from masthead.functions.prompt import render
from masthead.functions.validate import with_format_reason
from masthead.operators.decisions import (
    attempt,
    attempts,
    decide,
    first_call,
    refusal,
    union_all,
)
from masthead.operators.inference import REPAIR_CALL, ModelRunner
from masthead.sources.staging import Staging
from masthead.sources.templates import Templates

UNCHANGED = "same as the refused headline"


def with_repair(answered: DataFrame) -> DataFrame:
    """Add ``fixed``, the cleaned repair, and ``doubt``: why it is not even worth a critic call, its format or
    that nothing changed."""
    cleaned = with_clean_headline(answered.withColumn("_raw", F.col("safe")["text"]), "_raw", "fixed")
    unchanged = F.when(F.col("fixed") == F.col("proposed"), UNCHANGED)
    checked = with_format_reason(cleaned, "fixed", "_format")
    return checked.withColumn("doubt", F.coalesce("_format", unchanged)).drop("_raw", "_format")


def audit_headlines(
    candidates: DataFrame,
    model: ModelRunner,
    templates: Templates,
    staging: Staging,
    snippet_chars: int | None = SNIPPET_CHARS,
) -> DataFrame:
    """One decision per candidate (``id, rephrased_title, rephrased_article``).

    The critic sees the published headline as it is, and a repaired one after cleaning. Prompts show the first
    ``snippet_chars`` characters of an article, or with None all of it.
    """
    proposed = F.col("proposed")
    inputs = candidates.select("id", F.col("rephrased_title").alias("proposed"), "rephrased_article")
    answered = first_call(
        inputs, model, staging, snippet_chars, lambda a: model.critique(a, templates.critic, proposed, "critic")
    )
    judged = staging.save(answered, "critic")
    critic = F.col("critic")
    failed = critic["error"].isNotNull()
    approved = ~failed & critic["approved"]
    refused = ~failed & ~critic["approved"]

    wrong = (
        judged.filter(refused)
        .withColumn("first", attempt("published", proposed, refusal(critic)))
        .drop("critic")
    )
    prompt = render(templates.safe, body_snippet=F.col("snippet"))
    answered = model.generate(model.spread(wrong, "chars"), prompt, REPAIR_CALL, "safe")
    repaired = staging.save(with_repair(answered), "repair")
    safe, fixed, first = F.col("safe"), F.col("fixed"), F.col("first")
    doubt = F.when(safe["error"].isNull(), F.col("doubt"))
    worthwhile = safe["error"].isNull() & F.col("doubt").isNull()

    rejudged = staging.save(
        model.critique(model.spread(repaired.filter(worthwhile), "chars"), templates.critic, fixed, "critic").select(
            "id", "lead", "cause", "fixed", "first", "critic"
        ),
        "repair_critic",
    )

    # What leaves the funnel at each stage.
    lead, error = F.col("lead"), F.lit("error")
    rejected = refusal(critic)
    return union_all(
        [
            decide(
                judged.filter(~refused),
                outcome=F.when(failed, error).otherwise("validated"),
                headline=F.when(approved, proposed),
                verified=F.when(approved, 1),
                stage="critic",
                error=critic["error"],
            ),
            decide(
                repaired.filter(~worthwhile),
                outcome=F.when(safe["error"].isNotNull(), error).otherwise("fallback"),
                headline=F.when(safe["error"].isNull(), lead),
                verified=F.when(safe["error"].isNull(), 1),
                stage="repair",
                reason=doubt,
                error=safe["error"],
                tried=attempts(first, attempt("repair", fixed, doubt)),
            ),
            decide(
                rejudged,
                outcome=F.when(failed, error).when(refused, "fallback").otherwise("fixed"),
                headline=F.when(approved, fixed).when(refused, lead),
                verified=F.when(~failed, 1),
                stage="repair_critic",
                reason=rejected,
                error=critic["error"],
                tried=attempts(first, attempt("repair", fixed, rejected)),
            ),
        ]
    )
