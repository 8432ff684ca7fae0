"""Rules for articles that are not worth a headline. Off by default in the jobs: every article gets one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
MAX_CONTENT = 15000
TITLE_PHRASES = ["live updates", "explained", "from a to z"]
OPINION_START = "Opinion"
OPINION_TITLES = ["Opinion |", "| Comment", "Editorial:"]


def _any_of(text: Column, parts: list[str]) -> Column:
    found = text.contains(parts[0])
    for part in parts[1:]:
        found = found | text.contains(part)
    return found


def skip_reason(title: Column, content: Column) -> Column:
    """The first skip rule that applies, or NULL."""
    title = F.coalesce(title, F.lit(""))
    content = F.coalesce(content, F.lit(""))
    return (
        F.when(F.length(content) > MAX_CONTENT, "content too long")
        .when(_any_of(F.lower(title), TITLE_PHRASES), "title phrase")
        .when(title.rlike(r"\|[^|]*\|"), "title pipes")
        .when(content.startswith(OPINION_START), "opinion content")
        .when(_any_of(title, OPINION_TITLES), "opinion title")
    )


def should_skip(title: Column, content: Column) -> Column:
    return skip_reason(title, content).isNotNull()


def skip_articles(df: DataFrame, title: str = "title", content: str = "content") -> DataFrame:
    """Only the articles no skip rule applies to."""
    return df.filter(~should_skip(F.col(title), F.col(content)))
