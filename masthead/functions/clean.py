"""Headline cleaning: unwrap, drop one closing period, one blank between words, capital first letter.

``clean_headline`` is the whole chain as one expression. ``with_clean_headline`` computes the same in
steps on a DataFrame, so that intermediate values used more than once are evaluated once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from masthead.functions.text import WS, squeeze, strip

_WRAPPERS = "\"'*"
_STEPS = ("_bare", "_depth", "_unwrapped", "_flat")


def _edge(stripped: Column) -> Column:
    """The wrapper characters a text begins with, and the white space among them."""
    return F.regexp_extract(stripped, f"^[{_WRAPPERS}{WS}]*+", 0)


def _marks(edge: Column) -> Column:
    return F.regexp_replace(edge, f"[{WS}]+", "")


def wrapper_depth(stripped: Column) -> Column:
    """How many matching wrapper pairs enclose the text.

    The wrapper characters at the front, and those at the back read backwards, agree on exactly as many
    places as there are pairs to remove, so the depth is the length of their longest common prefix. A
    text made of wrappers alone that reads the same both ways agrees everywhere and vanishes whole.

    The prefix ends before the first place that differs. Written side by side, every place takes the eight characters
    of ``{a, b}, ``, so one search finds it in time linear in the number of wrappers.
    """
    front, back = _marks(_edge(stripped)), _marks(_edge(F.reverse(stripped)))
    shorter = F.least(F.length(front), F.length(back))
    places = F.arrays_zip(*[F.split(F.left(marks, shorter), "") for marks in (front, back)]).cast("string")
    differs = F.regexp_instr(places, F.lit(r"\{(.), (?!\1)"))
    agree = F.when(differs == 0, shorter).otherwise(F.floor((differs - 2) / 8).cast("int"))
    wrapped = F.substring(stripped, 1, 1).isin(list(_WRAPPERS)) & F.substring(stripped, -1, 1).isin(list(_WRAPPERS))
    return F.when(wrapped, agree).otherwise(0)


def _span(edge: Column, depth: Column) -> Column:
    """How many characters of ``edge`` lead up to its ``depth``-th wrapper, that one included."""
    blanks = F.array_join(F.slice(F.split(edge, f"[{_WRAPPERS}]"), F.lit(1), depth), "")
    return depth + F.length(blanks)


def unwrap(stripped: Column, depth: Column) -> Column:
    """Remove ``depth`` wrapper pairs and the white space between them."""
    front, back = _span(_edge(stripped), depth), _span(_edge(F.reverse(stripped)), depth)
    bare = F.substr(stripped, front + 1, F.length(stripped) - front - back)
    return F.when(depth > 0, strip(bare)).otherwise(stripped)


def peel(stripped: Column) -> Column:
    """Remove matching ``"…"``, ``'…'`` and ``*…*`` pairs, however deeply nested."""
    return unwrap(stripped, wrapper_depth(stripped))


def drop_period(text: Column) -> Column:
    """Remove one trailing period, and the white space before it."""
    return F.when(text.endswith("."), strip(F.regexp_replace(text, r"\.\z", ""))).otherwise(text)


def cap_first(text: Column) -> Column:
    """Upper-case the first character, leave the rest alone."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.substr(text, F.lit(2)))


def clean_headline(text: Column) -> Column:
    """The whole cleaning chain as one expression."""
    return cap_first(squeeze(drop_period(peel(strip(text)))))


def with_clean_headline(df: DataFrame, source: str, into: str) -> DataFrame:
    """Add the cleaned form of column ``source`` as column ``into``.

    The steps refer to each other by name within one projection; Catalyst evaluates each of them once.
    """
    bare, depth, unwrapped, flat = (F.col(name) for name in _STEPS)
    return df.select(
        "*",
        strip(F.col(source)).alias("_bare"),
        wrapper_depth(bare).alias("_depth"),
        unwrap(bare, depth).alias("_unwrapped"),
        squeeze(drop_period(unwrapped)).alias("_flat"),
        cap_first(flat).alias(into),
    ).drop(*_STEPS)
