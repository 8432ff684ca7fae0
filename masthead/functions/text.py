"""Whitespace and word helpers shared by the headline rules.

Everything here is ``Column -> Column`` over built-in expressions that take part in whole-stage code
generation: no Python per row, no higher-order functions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters counted as white space: tab to carriage return, the four separators, next line, and
# the Unicode separators. `WS` is the same set as the body of a Java character class.
WS = r"\t-\r\x1c-\x1f\x85\p{Z}"
WS_CHARS = "".join(
    chr(c)
    for c in [
        *range(0x09, 0x0E),
        *range(0x1C, 0x21),
        0x85,
        0xA0,
        0x1680,
        *range(0x2000, 0x200B),
        0x2028,
        0x2029,
        0x202F,
        0x205F,
        0x3000,
    ]
)


def strip(text: Column) -> Column:
    """Cut white space off both ends."""
    return F.btrim(text, F.lit(WS_CHARS))


def squeeze(text: Column) -> Column:
    """Strip, and turn every run of white space into one blank; NULL becomes the empty string."""
    return F.btrim(F.regexp_replace(F.coalesce(text, F.lit("")), f"[{WS}]+", " "))


def drop_markers(text: Column) -> Column:
    """Delete the markdown markers ``* _ ` #``; white space around them stays."""
    return F.regexp_replace(text, "[*_`#]+", "")


def word_count(stripped: Column) -> Column:
    """Number of white-space separated words of an already stripped text."""
    return F.when(stripped == "", 0).otherwise(F.size(F.split(stripped, f"[{WS}]+")))
