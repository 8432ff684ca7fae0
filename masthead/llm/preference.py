"""Preference pairs of conversations: the turns both share become the prompt, what follows two masked completions.

Built-in functions only. Turns meet their counterpart by pair and number, so the length of the common prefix is the
smallest number at which the two sides differ, one aggregate per pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TRAINED_ROLE = "assistant"


def rendered(role: Column, text: Column) -> Column:
    """A turn in the chat format."""
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("<|end|>\n"))


def _header(role: Column) -> Column:
    """Code points before the text of a rendered turn."""
    return F.length(role) + 5


def preference_pairs(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row per row of ``pairs`` (pair_id, chosen_id, rejected_id) whose two conversations have turns.

    Columns: those of ``pairs``, prompt_turns (length of the longest common prefix of turns, by role and text), prompt, chosen,
    rejected (rendered), chosen_mask and rejected_mask: the stretches ``start:end`` (code points of the completion) that are
    trained on, i.e. what assistant turns say with their end mark, comma-joined.

    ``turns`` has conv_id, turn, role, text. Turns are in the order of turn (nulls last), then role, then text; a null role counts
    as ``unknown`` and a null text as empty. Repeated turns are turns of their own. Turns or pairs without ids belong to nothing.
    Equal conversations give two empty completions. A pair of a conversation with itself does too. Empty tables give no rows.
    """
    clean = turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("unknown")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    numbered = clean.withColumn("nth", F.row_number().over(order)).select("conv_id", "nth", "role", "text")
    pairs = pairs.select("pair_id", "chosen_id", "rejected_id").dropna()
    sides = pairs.select("pair_id", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("chosen_id").alias("conv_id")), F.struct(F.lit(1).alias("side"), F.col("rejected_id").alias("conv_id")))).alias("s")).select("pair_id", "s.*")
    own = sides.join(numbered, "conv_id")
    # Both sides of a turn meet in one group of two rows at most.
    met = own.groupBy("pair_id", "nth").agg(
        *[F.max(F.when(F.col("side") == side, F.struct("role", "text"))).alias(name) for side, name in ((0, "chosen"), (1, "rejected"))]
    )
    differs = ~F.col("chosen").eqNullSafe(F.col("rejected"))
    joint = met.groupBy("pair_id").agg(
        F.coalesce(F.min(F.when(differs, F.col("nth"))) - 1, F.max("nth")).alias("prompt_turns"),
        *[F.sort_array(F.collect_list(F.when(F.col(s).isNotNull(), F.struct("nth", f"{s}.role", f"{s}.text")))).alias(s) for s in ("chosen", "rejected")],
    )
    prompt = F.filter("chosen", lambda t: t["nth"] <= F.col("prompt_turns"))
    out = joint.filter((F.size("chosen") > 0) & (F.size("rejected") > 0)).withColumn("prompt", _text(prompt))
    for side in ("chosen", "rejected"):
        rest = F.filter(side, lambda t: t["nth"] > F.col("prompt_turns"))
        out = out.withColumn(f"{side}_mask", _mask(rest)).withColumn(side, _text(rest))
    return pairs.join(out, "pair_id").select(
        "pair_id", "chosen_id", "rejected_id", "prompt_turns", "prompt", "chosen", "chosen_mask", "rejected", "rejected_mask"
    )


def _text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: rendered(t["role"], t["text"])), "")


def _mask(turns: Column) -> Column:
    """The trained stretches of the rendered turns."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("spans"))

    def step(done: Column, t: Column) -> Column:
        begin = done["at"] + _header(t["role"])
        end = done["at"] + F.length(rendered(t["role"], t["text"]))
        span = F.concat(F.when(done["spans"] == "", "").otherwise(","), begin.cast("string"), F.lit(":"), end.cast("string"))
        return F.struct(
            end.alias("at"), F.when(t["role"] == TRAINED_ROLE, F.concat(done["spans"], span)).otherwise(done["spans"]).alias("spans")
        )

    return F.aggregate(turns, start, step, lambda done: done["spans"])
