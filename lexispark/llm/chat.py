"""Preference formatting: a prompt and two masked completions per pair of conversations.

The longest common prefix of turns becomes the prompt, rendered once; what follows it
in either conversation becomes its completion, in which only assistant turns count
for training. All steps are built-in expressions on rows of single turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.llm.common import small_side
from lexispark.scale import materialize

PART_TURNS = 1024  # turns in one output row
LAST_TURN = (1 << 62) - 1  # where turns without a number stand
SIDES = ("chosen", "rejected")
TRAINED = "assistant"


def _side(name: str) -> Column:
    message = F.struct("role", "text")
    return F.array_sort(F.collect_list(F.when(F.col("side") == name, message))).alias(name)


def _segments(slots: str) -> Column:
    """The rendered pieces of turns, in order, and whether each counts for training: the
    head of a turn never does, its text and end mark do in an assistant turn."""
    pieces = F.transform(F.flatten(slots), lambda m: F.array(
        F.struct(F.concat(F.lit("<|"), m["role"], F.lit("|>\n")).alias("text"),
                 F.lit(False).alias("train")),
        F.struct(F.concat(m["text"], F.lit("<|end|>\n")).alias("text"),
                 (m["role"] == TRAINED).alias("train"))))
    return F.flatten(pieces)


def _text(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def _mask(segments: Column) -> Column:
    """Lengths of the pieces in characters, with + before those that count."""
    return F.array_join(F.transform(segments, lambda s: F.concat(
        F.when(s["train"], F.lit("+")).otherwise(F.lit("-")),
        F.length(s["text"]).cast("string"))), " ")


def format_preferences(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """Format the pairs given as turns (pair_id, side, turn, role, text), the side being
    "chosen" or "rejected".

    Returns pair_id, part, prompt_turns, prompt, and per side its completion and mask.
    A turn renders as ``<|role|>``, line feed, text, ``<|end|>``, line feed; ``<|`` inside
    a role or text becomes ``< |``. The mask gives the lengths of the pieces of a
    completion: "-14 +120" is a head that does not count and a text that does.

    A pair is one row, part 0, if its turns are numbered below ``part_turns``; longer
    ones have a row per so many turns, in order, so no row grows without bound.
    Messages with the same turn number are one turn, in order of role and text, repeated
    ones included. A null text is empty, a null role is "unknown", a turn without a
    number is last. Equal conversations are all prompt, with empty completions; a
    missing side is an empty conversation. Rows without a pair id or of another side are
    no part of any pair. Other columns are ignored.
    """

    def clean(column: str, empty: str) -> Column:
        return F.replace(F.coalesce(column, F.lit(empty)), F.lit("<|"), F.lit("< |")).alias(column)

    rows = turns.where(F.col("pair_id").isNotNull() & F.col("side").isin(*SIDES)).select(
        "pair_id", "side", F.coalesce(F.col("turn").cast("long"), F.lit(LAST_TURN)).alias("turn"),
        clean("role", "unknown"), clean("text", ""))
    slots = materialize(
        rows.groupBy("pair_id", "turn").agg(*map(_side, SIDES)), "preference-turns")
    ends = materialize(slots.groupBy("pair_id").agg(F.min(
        F.when(F.col("chosen") != F.col("rejected"), F.col("turn"))).alias("end")),
        "preference-prefixes")
    # Both sides are written tables: skewed partitions of a shuffle join are split.
    placed = slots.join(small_side(ends), "pair_id").withColumn(
        "common", F.col("turn") < F.coalesce("end", F.lit(LAST_TURN + 1)))

    def ordered(messages: str, which: Column) -> Column:
        listed = F.array_sort(F.collect_list(
            F.when(which, F.struct("turn", F.col(messages).alias("m")))))
        return F.transform(listed, lambda s: s["m"])

    parts = placed.groupBy("pair_id", F.floor(F.col("turn") / part_turns).alias("part")).agg(
        F.count_if("common").alias("prompt_turns"),
        ordered("chosen", F.col("common")).alias("prompt"),
        *[ordered(side, ~F.col("common")).alias(side) for side in SIDES])
    parts = parts.select("pair_id", "part", "prompt_turns", *[
        _segments(c).alias(c) for c in ("prompt", *SIDES)])
    return parts.select(
        "pair_id", "part", "prompt_turns", _text(F.col("prompt")).alias("prompt"),
        *[c for side in SIDES for c in (
            _text(F.col(side)).alias(side), _mask(F.col(side)).alias(f"{side}_mask"))])


def with_swapped_replies(conversations: DataFrame) -> DataFrame:
    """Pairs for a preference set from ``conversations`` (conv_id, turn, role, text): the
    chosen side is the conversation, the rejected one ends in the last reply of another
    one, that with the next id, or with the smallest id if there is none.

    Conversations without an assistant turn give no pair, nor do rows without a
    conversation id. Of several replies at the last turn all are swapped, and the greatest
    is the one that others take.
    """
    rows = conversations.select("conv_id", "turn", "role", "text").where("conv_id is not null")
    replies = materialize(
        rows.where(F.col("role") == TRAINED).groupBy("conv_id").agg(
            F.max(F.struct(F.coalesce("turn", F.lit(-1)).alias("turn"),
                           F.coalesce("text", F.lit("")).alias("text"))).alias("last")),
        "preference-replies")
    first = replies.agg(F.min_by("last", "conv_id")["text"].alias("text"))
    following = replies.select((F.col("conv_id") - 1).alias("conv_id"),
                               F.col("last")["text"].alias("next"))
    swaps = materialize(replies.join(following, "conv_id", "left").select(
        "conv_id", F.col("last")["turn"].alias("last"),
        F.col("next").alias("other")), "preference-swaps")
    wrap = first.first()["text"]
    swaps = swaps.withColumn("other", F.coalesce("other", F.lit(wrap).cast("string")))
    chosen = rows.join(swaps, "conv_id").select(
        F.col("conv_id").alias("pair_id"), "turn", "role", "text", "last", "other")
    rejected = F.when(
        (F.col("turn") == F.col("last")) & (F.col("role") == TRAINED), F.col("other")
    ).otherwise(F.col("text"))
    sides = F.explode(F.array(
        F.struct(F.lit("chosen").alias("side"), F.col("text").alias("said")),
        F.struct(F.lit("rejected").alias("side"), rejected.alias("said")))).alias("s")
    return chosen.select("pair_id", "turn", "role", sides).select(
        "pair_id", "s.side", "turn", "role", F.col("s.said").alias("text"))
