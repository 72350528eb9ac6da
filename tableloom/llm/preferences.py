"""Preference data from conversations, with DataFrame functions only.

Two conversations of a pair share a prefix of turns. It is rendered once as the prompt; what follows in each is a
completion, with the ranges of characters a model is to learn from: what the assistant says.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"

#: The role whose turns are learned.
LEARNED = "assistant"


def gathered(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turns`` with the turns of each conversation in order, as ``role, text``.

    Null roles are ``unknown`` and null texts empty; a null turn number comes first, and turns of one number are ordered by
    role and text, repeated ones staying. Rows without a conv_id belong to no conversation. One conversation is one record.
    """
    rows = turns.where(F.col(f"`{conv_id}`").isNotNull()).select(
        F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("unknown")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    ordered = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    return rows.groupBy("conv_id").agg(F.transform(ordered, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def pairs_by_opening(conversations: DataFrame) -> DataFrame:
    """``chosen_id, rejected_id``: of the conversations with one opening turn, that with the most said by the assistant is chosen
    (of equal ones the smallest conv_id), and each other one is rejected against it.

    Openings are grouped by digest and the best found on the map side, so a very common opening gathers nothing.
    """
    opening = F.sha2(F.to_json(F.element_at("turns", 1)), 256)
    rows = conversations.select("conv_id", opening.alias("opening"), _said(F.col("turns")).alias("said"))
    best = rows.groupBy("opening").agg(F.min(F.struct((-F.col("said")).alias("less"), "conv_id"))["conv_id"].alias("chosen_id"))
    return rows.join(best, "opening").where("conv_id <> chosen_id").select("chosen_id", F.col("conv_id").alias("rejected_id"))


def pairs_by_number(conversations: DataFrame) -> DataFrame:
    """``chosen_id, rejected_id`` of each two conversations numbered 2n and 2n + 1, chosen by the same rule."""
    rows = conversations.select(
        "conv_id", F.shiftright("conv_id", 1).alias("two"), (-_said(F.col("turns"))).alias("less")
    )
    best = F.struct("less", "conv_id")
    two = rows.groupBy("two").agg(F.min(best)["conv_id"].alias("chosen_id"), F.max(best)["conv_id"].alias("rejected_id"))
    return two.where("chosen_id <> rejected_id").select("chosen_id", "rejected_id")


def _said(turns: Column) -> Column:
    """How many characters the assistant says."""
    return F.aggregate(turns, F.lit(0).cast("long"), lambda n, t: n + F.when(t["role"] == LEARNED, F.length(t["text"])).otherwise(0))


def _escaped(text: Column) -> Column:
    """The text with marker strings made harmless: a backslash goes between their first two characters."""
    return F.regexp_replace(text, r"<(\\*)\|im_", r"<$1\\|im_")


def _rendered(t: Column) -> Column:
    return F.concat(F.lit(OPEN), _escaped(t["role"]), F.lit("\n"), _escaped(t["text"]), F.lit(CLOSE + "\n"))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def _mask(turns: Column) -> Column:
    """Ranges of a rendered completion that are learned: the text of each assistant turn with its closing marker."""
    nothing = F.array().cast("array<struct<start:int,end:int>>")

    def step(acc, t):
        begin = acc["at"] + len(OPEN) + F.length(_escaped(t["role"])) + 1
        end = begin + F.length(_escaped(t["text"])) + len(CLOSE)
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct((end + 1).alias("at"), F.when(t["role"] == LEARNED, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, F.struct(F.lit(0).alias("at"), nothing.alias("spans")), step)["spans"]


def format_pairs(conversations: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row per pair: ``chosen_id, rejected_id, n_common, prompt, chosen, rejected, chosen_mask, rejected_mask``.

    The prompt holds the turns that both begin with; if one conversation is a beginning of the other, its completion is
    empty, and both are if the two are equal. Masks are ranges of characters of their completion, end exclusive. A pair that
    names an unknown conversation has no row; a repeated pair is one row. Empty tables give no rows.
    """
    left = conversations.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("c"))
    right = conversations.select(F.col("conv_id").alias("rejected_id"), F.col("turns").alias("r"))
    both = pairs.select("chosen_id", "rejected_id").distinct().join(right, "rejected_id").join(left, "chosen_id")
    least = F.least(F.size("c"), F.size("r"))
    same = F.zip_with(F.slice("c", F.lit(1), least), F.slice("r", F.lit(1), least), lambda x, y: (x["role"] == y["role"]) & (x["text"] == y["text"]))
    differ = F.array_position(same, F.lit(False)).cast("int")
    both = both.withColumn("n_common", F.when(differ == 0, least).otherwise(differ - 1))
    rest = lambda c: F.slice(c, F.col("n_common") + 1, F.size(c))
    return both.select(
        "chosen_id", "rejected_id", "n_common", _render(F.slice("c", F.lit(1), F.col("n_common"))).alias("prompt"),
        _render(rest("c")).alias("chosen"), _render(rest("r")).alias("rejected"), _mask(rest("c")).alias("chosen_mask"), _mask(rest("r")).alias("rejected_mask"),
    )


def listed(mask: Column) -> Column:
    """``start:end``, comma-joined."""
    return F.array_join(F.transform(mask, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
