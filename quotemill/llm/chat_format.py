"""Preference formatting of paired conversations (operator 2), DataFrame functions only.

A chosen and a rejected conversation share their first turns.  The longest common
prefix is rendered once as the prompt; what follows on either side is rendered as
that side's completion, masked so that only assistant turns are trained on.

Conversations stay tables of turns: the two sides meet in one aggregation by
(pair, turn, role, text), and the first turn at which they differ is a partially
aggregated minimum.  No conversation is gathered into one value, so one that
holds a third of all turns is as well spread as any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rendering of one turn: opening, closing.
OPEN, CLOSE = "<|{}|>\n", "<|end|>\n"


def render(role: Column, text: Column) -> Column:
    """One turn as training text; a null role is ``unknown``, a null text empty."""
    before, after = OPEN.split("{}")
    return F.concat(F.lit(before), F.coalesce(role, F.lit("unknown")), F.lit(after),
                    F.coalesce(text, F.lit("")), F.lit(CLOSE))


def preference_segments(chosen: DataFrame, rejected: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """Two tables ``pair_id, turn, role, text`` -> the segments of every pair.

    Result: ``pair_id, part, turn, role, copies, mask, rendered``; ``part`` is
    ``prompt``, ``chosen`` or ``rejected``, and a part reads in order of turn, role,
    rendered.  ``mask`` is 1 on assistant turns of completions, else 0.

    Turns compare equal when position, role and text agree, nulls included.  Rows
    repeated within a side make one segment with ``copies`` above 1 and compare by
    that number.  Rows of one position (ties) stand together, in order of role
    and text: the prefix ends before a position of which any row differs.  A null position is
    before all others; null pair ids form one pair.  A pair known on one side
    only has an empty prompt, and equal sides make a prompt without completions.  Empty tables
    give an empty result.
    """
    cols = ["pair_id", "turn", "role", "text"]
    # One row per different turn, with how often each side has it: both sides go through one aggregation.
    one = chosen.select(*cols, F.lit(1).alias("c"), F.lit(0).alias("r"))
    two = rejected.select(*cols, F.lit(0).alias("c"), F.lit(1).alias("r"))
    turns = one.unionByName(two).groupBy(*cols).agg(F.sum("c").alias("c"), F.sum("r").alias("r"))
    at = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    turns = turns.withColumn("at", at)
    parts = turns.groupBy(F.col("pair_id").alias("p")).agg(F.min(F.when(F.col("c") != F.col("r"), F.col("at"))).alias("first"))
    turns = turns.join(parts, F.col("pair_id").eqNullSafe(F.col("p")))
    shared = F.col("first").isNull() | (F.col("at") < F.col("first"))

    def segment(part, n):
        return F.struct(F.lit(part).alias("part"), F.col(n).alias("copies"))

    sides = F.when(shared, F.array(segment("prompt", "c"))).otherwise(
        F.filter(F.array(segment("chosen", "c"), segment("rejected", "r")), lambda s: s["copies"] > 0))
    out = turns.select("pair_id", "turn", "role", "text", F.inline(sides))
    trained = (F.col("part") != "prompt") & F.coalesce(F.col("role") == trained_role, F.lit(False))
    return out.select("pair_id", "part", "turn", "role", "copies", trained.cast("int").alias("mask"),
                      render(F.col("role"), F.col("text")).alias("rendered"))


def swapped_answers(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs out of one table ``conv_id, turn, role, text``: chosen and rejected sides.

    Chosen is every conversation as it stands.  Rejected is the same conversation with
    the text of its last assistant turn replaced by that of the conversation whose
    conv_id differs in the lowest bit.  Where that one is missing, has no
    assistant turn, or the conversation has none itself, both sides are equal.
    """
    last = turns.where("role = 'assistant' and turn is not null").groupBy("conv_id").agg(
        F.max(F.struct("turn", "text")).alias("last"))
    other = last.select(F.expr("conv_id ^ 1").alias("o"), F.col("last.text").alias("other_text"))
    mine = last.select(F.col("conv_id").alias("i"), F.col("last.turn").alias("last_turn"))
    # A conversation's last position and the answer that goes there, then one join with its turns.
    swaps = mine.join(other, F.col("i") == F.col("o")).select("i", "last_turn", "other_text")
    joined = turns.select("conv_id", "turn", "role", "text").join(swaps, F.col("conv_id") == F.col("i"), "left")
    hit = (F.col("role") == "assistant") & (F.col("turn") == F.col("last_turn"))
    text = F.when(hit, F.col("other_text")).otherwise(F.col("text"))
    chosen = turns.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    return chosen, joined.select(F.col("conv_id").alias("pair_id"), "turn", "role", text.alias("text"))
