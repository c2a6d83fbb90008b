"""Preference formatting: one prompt and two masked completions from a chosen and a rejected conversation.

The prompt is the longest common prefix of turns (same role, same text), rendered once. Each completion is the rest of its
conversation. ``chosen_spans`` and ``rejected_spans`` are the character ranges of a completion that carry loss: the text of
assistant turns with its end mark. Headers, other roles and the prompt are masked. A pair is ``usable`` if both completions
carry loss and differ.

Turns are rendered as START role NEWLINE text END NEWLINE; marks inside a text are broken up by spaces, so they can't end a turn.

Conversations are arrays of turns in one row: a training example has to fit a row anyway. Turns are ordered by (turn, role,
text), missing ones first.

Defined results: rows without a conversation belong to none and are left out; a missing role is ``user`` and a missing text is
empty, also when turns are compared; repeated turns count as often as they occur; a pair that is missing on one side has an empty
conversation there and is not usable; empty tables give no rows. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import bucket_count, ranked
from marketloom.session import durable

START, END = "<|im_start|>", "<|im_end|>"
_TURNS = "array<struct<turn:bigint,role:string,text:string>>"


def conversations(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(conv, turns): the turns of each conversation in order."""
    role, text = F.coalesce("role", F.lit("user")), F.coalesce("text", F.lit(""))
    turn = F.struct(F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    rows = turns.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("conv"), turn.alias("turn"))
    return rows.groupBy("conv").agg(F.sort_array(F.collect_list("turn")).alias("turns"))


def _said(turn: Column) -> Column:
    return F.regexp_replace(turn["text"], r"<\|(im_start|im_end)\|>", "<| $1 |>")


def _head(turn: Column) -> Column:
    return F.concat(F.lit(START), F.regexp_replace(turn["role"], r"[\r\n<|>]", " "), F.lit("\n"))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _said(t), F.lit(END + "\n"))), "")


def _spans(turns: Column) -> Column:
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        begin = state["at"] + F.length(_head(turn))
        end = begin + F.length(_said(turn)) + len(END)
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        spans = F.when(turn["role"] == "assistant", F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct((end + 1).alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, step, lambda s: s["spans"])


def _common(a: Column, b: Column) -> Column:
    """Number of leading turns that are equal."""
    both = F.arrays_zip(F.transform(a, lambda t: F.struct(t["role"], t["text"])), F.transform(b, lambda t: F.struct(t["role"], t["text"])))
    differs = F.array_position(F.transform(both, lambda x: x["0"].eqNullSafe(x["1"])), False)
    return F.when(differs > 0, differs - 1).otherwise(F.least(F.size(a), F.size(b))).cast("int")


def format_pairs(pairs: DataFrame) -> DataFrame:
    """``pairs`` (pair, chosen, rejected; arrays of turns) as one row per pair."""
    none = F.array().cast(_TURNS)
    rows = pairs.select("pair", F.coalesce("chosen", none).alias("a"), F.coalesce("rejected", none).alias("b"))
    rows = rows.withColumn("n", _common(F.col("a"), F.col("b")))
    rest = lambda c: F.slice(c, F.col("n") + 1, F.size(c))
    rows = rows.select("pair", "n", F.slice("a", 1, F.col("n")).alias("p"), rest("a").alias("a"), rest("b").alias("b"))
    rows = rows.select(
        "pair",
        F.col("n").alias("prompt_turns"),
        _render(F.col("p")).alias("prompt"),
        _render(F.col("a")).alias("chosen"),
        _spans(F.col("a")).alias("chosen_spans"),
        _render(F.col("b")).alias("rejected"),
        _spans(F.col("b")).alias("rejected_spans"),
    )
    usable = (F.size("chosen_spans") > 0) & (F.size("rejected_spans") > 0) & (F.col("chosen") != F.col("rejected"))
    return rows.withColumn("usable", usable)


def preferences(chosen: DataFrame, rejected: DataFrame, pair_col: str = "conv_id") -> DataFrame:
    """From two tables of turns (pair, turn, role, text); the pairs of either."""
    a = conversations(chosen, pair_col).select(F.col("conv").alias("pair"), F.col("turns").alias("chosen"))
    b = conversations(rejected, pair_col).select(F.col("conv").alias("pair"), F.col("turns").alias("rejected"))
    return format_pairs(a.join(b, "pair", "full_outer"))


def mismatched(turns: DataFrame) -> DataFrame:
    """(pair, chosen, rejected) for a table without preferences: the conversation up to its last assistant turn, and the same with the
    last reply of another conversation (the next one in a hashed order) in that place.

    A conversation without an assistant turn is rejected as it is, which makes an unusable pair.
    """
    convs = durable(conversations(turns), "conversations")
    is_reply = F.transform("turns", lambda t: t["role"] == "assistant")
    last = F.size("turns") - F.array_position(F.reverse(is_reply), True) + 1  # from 1
    convs = convs.withColumn("last", F.when(F.array_contains(is_reply, True), last).cast("int"))
    replies = convs.where("last is not null").select("conv", F.element_at("turns", F.col("last"))["text"].alias("reply"))
    n = replies.count()
    buckets = bucket_count(n)
    order = F.xxhash64("conv", F.lit("ring"))
    replies = replies.withColumn("__order", order).withColumn("__bucket", F.pmod("__order", F.lit(buckets)).cast("int"))
    placed = durable(ranked(replies, [], "__bucket", [F.col("__order"), F.col("conv")], "place"), "replies")
    other = placed.select(F.pmod(F.col("place") - 1, F.lit(max(n, 1))).alias("place"), F.col("reply").alias("other"))
    swapped = placed.select("conv", "place").join(other, "place").select("conv", "other")
    rows = convs.join(swapped, "conv", "left")
    chosen = F.when(F.col("last").isNotNull(), F.slice("turns", 1, F.coalesce("last", F.lit(0)))).otherwise(F.col("turns"))
    rows = rows.withColumn("chosen", chosen)
    swap = F.transform(
        "chosen",
        lambda t, i: F.when(
            i + 1 == F.col("last"), F.struct(t["turn"].alias("turn"), t["role"].alias("role"), F.col("other").alias("text"))
        ).otherwise(t),
    )
    rejected = F.when(F.col("last").isNotNull(), swap).otherwise(F.col("chosen"))
    return rows.select(F.col("conv").alias("pair"), "chosen", rejected.alias("rejected"))
