"""Operator 5: preference pairs as a shared prompt and two masked completions.

The longest common turn prefix (same role and text) of the chosen and the
rejected conversation is rendered once as the prompt; what follows in either
is its completion, with the spans of characters that count for the loss:
assistant text and its end mark. DataFrame functions only.

A pair is one row of the result, so its turns meet in one task; rows that
repeat are dropped before that, map-side.

Defined results: turns are ordered by turn, then role, then text, null last;
a turn given twice (same number, role and text) counts once; null role is
rendered as `user`, null text as the empty text, and both compare as such; a
turn without a pair id is left out; a pair with one side only has null for the
other completion and the whole of its side as prompt-less completion; equal
sides are all prompt with empty completions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the chat template.
START, END = "<|im_start|>", "<|im_end|>\n"
TRAINED_ROLE = "assistant"
BLOCK = 64  # turns whose spans are gathered in one fold


def _rendered(turns: Column) -> Column:
    """Text of each turn under the template."""
    return F.transform(turns, lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"), t["text"], F.lit(END)))


def _spans(turns: Column) -> Column:
    """[begin, end) of each trained stretch in the joined text of `turns`, in characters.

    A fold copies the spans it has at every turn, so it runs over `BLOCK` turns
    at a time, and a second one over the blocks moves theirs to their place.
    """
    spans = "array<struct<begin:long,end:long>>"
    n_blocks = F.ceil(F.size(turns) / BLOCK).cast("int")
    numbers = F.when(n_blocks > 0, F.sequence(F.lit(0), n_blocks - 1)).otherwise(F.array().cast("array<int>"))

    def step(state: Column, t: Column) -> Column:
        begin = state["at"] + F.lit(len(START) + 1) + F.length(t["role"])
        end = begin + F.length(t["text"]) + F.lit(len(END))
        span = F.struct(begin.cast("long").alias("begin"), end.cast("long").alias("end"))
        return F.struct(end.cast("long").alias("at"),
                        F.when(t["role"] == TRAINED_ROLE, F.concat(state["spans"], F.array(span)))
                        .otherwise(state["spans"]).alias("spans"))

    def within(k: Column) -> Column:
        empty = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(spans).alias("spans"))
        return F.aggregate(F.slice(turns, k * BLOCK + 1, F.lit(BLOCK)), empty, step)

    def moved(state: Column, block: Column) -> Column:
        own = F.transform(block["spans"], lambda s: F.struct((s["begin"] + state["at"]).alias("begin"), (s["end"] + state["at"]).alias("end")))
        return F.struct((state["at"] + block["at"]).alias("at"), F.concat(state["blocks"], F.array(own)).alias("blocks"))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{spans}>").alias("blocks"))
    return F.flatten(F.aggregate(F.transform(numbers, within), start, moved, lambda s: s["blocks"]))


def format_pairs(turns: DataFrame) -> DataFrame:
    """One row per pair of `turns` (pair_id, chosen boolean, turn, role, text).

    (pair_id, prefix_turns, prompt, chosen, chosen_spans, rejected, rejected_spans)
    """
    turn = F.struct(F.coalesce("turn", F.lit(2**63 - 1)).alias("turn"), F.coalesce("role", F.lit("user")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
    sides = (turns.where("pair_id is not null and chosen is not null").groupBy("pair_id")
             .agg(F.sort_array(F.collect_set(F.when(F.col("chosen"), turn))).alias("c"),
                  F.sort_array(F.collect_set(F.when(~F.col("chosen"), turn))).alias("r")))
    # Turns differ at these positions; the first one ends the prefix.
    shorter = F.least(F.size("c"), F.size("r"))
    positions = F.when(shorter > 0, F.sequence(F.lit(1), shorter)).otherwise(F.array().cast("array<int>"))
    differs = F.filter(positions, lambda i: (F.element_at("c", i)["role"] != F.element_at("r", i)["role"])
                       | (F.element_at("c", i)["text"] != F.element_at("r", i)["text"]))
    rows = (sides.withColumn("prefix_turns", F.coalesce(F.get(differs, F.lit(0)) - 1, shorter))
            .withColumn("p", F.slice("c", F.lit(1), F.col("prefix_turns")))
            .withColumn("cc", F.slice("c", F.col("prefix_turns") + 1, F.greatest(F.size("c"), F.lit(1))))
            .withColumn("rr", F.slice("r", F.col("prefix_turns") + 1, F.greatest(F.size("r"), F.lit(1)))))
    has_c, has_r = F.size("c") > 0, F.size("r") > 0
    return rows.select(
        "pair_id", "prefix_turns", F.array_join(_rendered(F.col("p")), "").alias("prompt"),
        F.when(has_c, F.array_join(_rendered(F.col("cc")), "")).alias("chosen"),
        F.when(has_c, _spans(F.col("cc"))).alias("chosen_spans"),
        F.when(has_r, F.array_join(_rendered(F.col("rr")), "")).alias("rejected"),
        F.when(has_r, _spans(F.col("rr"))).alias("rejected_spans"))


def neighbour_pairs(conversations: DataFrame) -> DataFrame:
    """Turns of `conversations`, paired by number: 2k is the chosen and 2k + 1 the rejected one of pair k."""
    conv = F.col("conv_id").cast("long")
    return conversations.select(F.floor(conv / 2).cast("long").alias("pair_id"), (F.pmod(conv, F.lit(2)) == 0).alias("chosen"),
                                F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"),
                                F.col("text").cast("string").alias("text"))
