"""A headline taken from the opening sentence of the article, for when no model text passes.

The opening sentence ends at the first ``.``, ``!`` or ``?`` that white space follows once the markdown
markers are gone. The expression finds that place in the raw text, so the regex engine stops there, and only
the sentence (not the whole article) is normalised. Text without such a place is one sentence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from masthead.functions.clean import with_clean_headline
from masthead.functions.text import WS, drop_markers, squeeze

# ---- Fixed values ------------------------------------------------------------------------------------
LONG_SENTENCE = 14  # more words than this and the sentence is cut
KEPT_WORDS = 12  # ... to this many
GERUND_AFTER = 6  # a closing "-ing" word is dropped only beyond this position
LEAST_WORDS = 3  # fewer words left than this and the trimming is undone

# Words a headline must not end on.
TAIL_WORDS = """
    a an the of to in on at for with and or
    but as by when while after before that which
    who whose its his her their over under against
    amid despite during is are was were has have
    had will would could should may might been being
    from into about than because if so not no
    new other several various more most key top
    major latest former first last this these those
    such any all both each every few many some
""".split()

# Opening date clause, "On <month> <day>, <year>, ".
DATE_LEAD = (
    r"(?iu)^On\s+(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\.?"
    r"\s+\p{Nd}{1,2},?\s+\p{Nd}{4},?\s*"
)
# ------------------------------------------------------------------------------------------------------

_SENTENCE = f"(?s)^.*?[.!?][*_`#]*(?=[{WS}])"


def first_sentence(content: Column) -> Column:
    """The opening sentence, white space collapsed and markdown markers deleted."""
    raw = F.coalesce(F.regexp_substr(content, F.lit(_SENTENCE)), content)
    return drop_markers(squeeze(raw))


def drop_date_lead(sentence: Column) -> Column:
    """The sentence without an opening date clause."""
    return F.regexp_replace(sentence, DATE_LEAD, "")


def sentence_words(sentence: Column) -> Column:
    """Words of a squeezed sentence. Only "more than 14" and the first words matter, so splitting stops there."""
    return F.split(F.btrim(sentence), " +", LONG_SENTENCE + 1)


def capped_count(words: Column) -> Column:
    """How many words are considered: all of them, or 12 if there are more than 14."""
    return F.when(F.size(words) > LONG_SENTENCE, KEPT_WORDS).otherwise(F.size(words))


# What a word can be that a headline may not end on, marks around it included; and where a word ends.
_MARKS = "[.,;:\"']*"
_WEAK = f"{_MARKS}(?:{'|'.join(TAIL_WORDS)}){_MARKS}(?: |$)"
_END = "(?= |$)"
# The longest run of first words that ends on a good one: behind GERUND_AFTER words no "-ing" word is good.
_SOLID = (
    f"^(?:(?:[^ ]+ ){{{GERUND_AFTER},}}(?!{_WEAK})(?![^ ]*ing(?: |$))[^ ]+{_END}"
    f"|(?:[^ ]+ ){{0,{GERUND_AFTER - 1}}}(?!{_WEAK})[^ ]+{_END})"
)


def kept_words(words: Column) -> Column:
    """How many of the words (in lower case) stay: up to the last one a headline may end on, 0 if none.

    A word is dropped only if all behind it are, so its own position is the length it is judged at. One pattern finds the
    place, tried from the back; a test at every position would make a method too long for the JIT.
    """
    kept = F.regexp_extract(F.array_join(words, " "), _SOLID, 0)
    return F.when(kept == "", 0).otherwise(F.size(F.split(kept, " ")))


def trim_tail(words: Column, kept: Column) -> Column:
    """The headline text: the kept words, or the first 12 untrimmed if too few are left."""
    count = F.when(kept < LEAST_WORDS, KEPT_WORDS).otherwise(kept)
    return F.rtrim(F.array_join(F.slice(words, F.lit(1), count), " "), F.lit(".,;: "))


def with_lead_headline(df: DataFrame, content: str, into: str) -> DataFrame:
    """Add the lead headline of column ``content`` as column ``into``; empty content gives the empty string."""
    sentence, words, kept = F.col("_sentence"), F.col("_words"), F.col("_kept")
    steps = df.select(
        "*",
        drop_date_lead(first_sentence(F.col(content))).alias("_sentence"),
        sentence_words(sentence).alias("_words"),
        capped_count(words).alias("_count"),
        sentence_words(F.lower(sentence)).alias("_lower"),
        kept_words(F.slice(F.col("_lower"), F.lit(1), F.col("_count"))).alias("_kept"),
        trim_tail(words, kept).alias("_lead"),
    )
    return with_clean_headline(steps, "_lead", into).drop("_sentence", "_words", "_lower", "_count", "_kept", "_lead")
