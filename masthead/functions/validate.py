"""Mechanical format check of a headline. The first rule that fails gives the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from masthead.functions.text import strip, word_count

# Word limits, the last code point of the accepted scripts, and the reason strings.
MIN_WORDS = 3
MAX_WORDS = 14
EMPTY = "empty headline"
TOO_SHORT = "too short"
TOO_LONG = "exceeds 14 words"
NON_LATIN = "contains non-Latin script characters"

_FOREIGN_LETTER = r"[\p{L}&&[^\x{0}-\x{24F}]]"


def has_non_latin(text: Column) -> Column:
    """True if any letter lies above U+024F; symbols and digits do not count."""
    return text.rlike(_FOREIGN_LETTER)


def _reason(text: Column, words: Column) -> Column:
    # Asked in the order of likelihood; the reasons exclude each other but for the last, which comes last.
    return (
        F.when(words.between(MIN_WORDS, MAX_WORDS), F.when(has_non_latin(text), NON_LATIN))
        .when(words > MAX_WORDS, F.concat(F.lit("length "), words.cast("string"), F.lit(f" {TOO_LONG}")))
        .when(words > 0, TOO_SHORT)
        .otherwise(EMPTY)
    )


def format_reason(headline: Column) -> Column:
    """Why the headline is not acceptable, or NULL if it is. A NULL headline counts as empty."""
    text = F.coalesce(strip(headline), F.lit(""))
    return _reason(text, word_count(text))


def with_format_reason(df: DataFrame, headline: str, into: str) -> DataFrame:
    """Add the reason for column ``headline`` as column ``into``; the words are counted once."""
    text, words = F.col("_text"), F.col("_word_count")
    return df.select(
        "*",
        F.coalesce(strip(F.col(headline)), F.lit("")).alias("_text"),
        word_count(text).alias("_word_count"),
        _reason(text, words).alias(into),
    ).drop("_text", "_word_count")


def validate_headline(headline: Column) -> Column:
    """The check as ``struct<valid, reason>``."""
    reason = format_reason(headline)
    return F.struct(reason.isNull().alias("valid"), reason.alias("reason"))


def reason_kind(reason: Column) -> Column:
    """The reason without its word count, for counting rows per kind."""
    return F.regexp_replace(reason, r"^length \d+ ", "length ")
