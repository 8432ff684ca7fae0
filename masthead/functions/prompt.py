"""Prompt rendering and reading of model answers."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

from masthead.functions.text import strip

# Strings at which a model text ends.
STOPS = ("<|im_end|>", "Article:", "<|im_start|>")


def render(template: str, **slots: Column) -> Column:
    """Fill the ``{slot}`` places of a template.

    The template is cut into its literal pieces once, on the driver; braces inside the inserted text are
    never looked at again.
    """
    pieces: list[Column] = []
    for literal, slot, _, _ in Formatter().parse(template):
        if literal:
            pieces.append(F.lit(literal))
        if slot is not None:
            pieces.append(F.coalesce(slots[slot], F.lit("")))
    return F.concat(*pieces) if pieces else F.lit("")


def cut_at_stops(text: Column, stops: tuple[str, ...] = STOPS) -> Column:
    """The stripped text before whichever stop string comes first."""
    for stop in stops:
        text = F.substring_index(text, stop, 1)
    return strip(text)


def verdict(answer: Column) -> Column:
    """True only for an answer that contains YES and does not contain NO, in any case."""
    text = F.upper(F.coalesce(answer, F.lit("")))
    return text.contains("YES") & ~text.contains("NO")
