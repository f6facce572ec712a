"""Preference formatting of paired conversations.

For each pair the longest common turn prefix of the chosen and the rejected
conversation is found (same role and text, null equal to null) and rendered
once as the prompt; what follows in either is rendered as its completion.  A
completion comes with a mask: the code point spans, relative to the
completion, that belong to assistant text and its end mark and so count for
the loss.

Everything is array work inside one row, so formatting needs no shuffle; the
turns of a conversation are gathered with one grouping by its id.

Defined cases: null roles and texts render as empty; turns tie-break by role,
then text; repeated rows of a turn count once; equal conversations give empty
completions and ``same`` = true; a conversation without a partner (or whose
partner has no assistant turn) has the empty reply as its rejected one; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>"


def gather_turns(rows: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, turns array<struct<role, text>> in turn order."""
    turn = F.struct(F.col("turn"), F.col("role"), F.col("text"))
    return rows.groupBy("conv_id").agg(
        F.transform(F.array_sort(F.collect_set(turn)),
                    lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def common_prefix_length(a: Column, b: Column) -> Column:
    """Number of leading turns that the two arrays share."""
    shorter = F.least(F.size(a), F.size(b))
    differs = F.filter(F.sequence(F.lit(0), shorter),
                       lambda i: (i == shorter) | ~F.get(a, i).eqNullSafe(F.get(b, i)))
    return F.element_at(differs, 1)


def _head(turn: Column) -> Column:
    return F.concat(F.lit(TURN_START), F.coalesce(turn["role"], F.lit("")), F.lit("\n"))


def _body(turn: Column) -> Column:
    return F.concat(F.coalesce(turn["text"], F.lit("")), F.lit(TURN_END))


def render(turns: Column) -> Column:
    return F.concat_ws("", F.transform(turns, lambda t: F.concat(_head(t), _body(t), F.lit("\n"))))


def loss_spans(turns: Column, role: str = "assistant") -> Column:
    """array<struct<start, end>>: code points of ``render(turns)`` that ``role`` wrote."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        begin = acc["at"] + F.length(_head(t))
        end = begin + F.length(_body(t))
        own = F.coalesce(t["role"] == role, F.lit(False))
        return F.struct((end + 1).alias("at"),
                        F.when(own, F.concat(acc["spans"], F.array(F.struct(begin.alias("start"), end.alias("end")))))
                        .otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda acc: acc["spans"])


def format_preferences(pairs: DataFrame) -> DataFrame:
    """``pairs`` (chosen, rejected: array<struct<role, text>>) plus n_common, prompt,
    chosen_text, rejected_text, chosen_mask, rejected_mask, same."""
    n = common_prefix_length(F.col("chosen"), F.col("rejected"))
    rest = lambda c: F.slice(F.col(c), F.col("n_common") + 1, F.greatest(F.size(c) - F.col("n_common"), F.lit(0)))
    return (pairs.withColumn("n_common", n)
            .withColumns({"_c": rest("chosen"), "_r": rest("rejected")})
            .withColumns({"prompt": render(F.slice("chosen", F.lit(1), F.col("n_common"))),
                          "chosen_text": render(F.col("_c")), "rejected_text": render(F.col("_r")),
                          "chosen_mask": loss_spans(F.col("_c")), "rejected_mask": loss_spans(F.col("_r")),
                          "same": (F.size("_c") == 0) & (F.size("_r") == 0)})
            .drop("_c", "_r"))


def swapped_reply_pairs(convs: DataFrame) -> DataFrame:
    """A pair per conversation: chosen is itself; rejected has its last assistant
    turn, and all after it, replaced by the last assistant turn of its partner
    (the conversation whose id differs in the lowest bit)."""
    idx = F.filter(F.sequence(F.lit(1), F.size("turns")),
                   lambda i: F.coalesce(F.get(F.col("turns"), i - 1)["role"] == "assistant", F.lit(False)))
    own = convs.withColumn("_last", F.when(F.size(idx) > 0, F.element_at(idx, -1)))
    replies = own.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("_of"),
                         F.when(F.col("_last").isNotNull(), F.get(F.col("turns"), F.col("_last") - 1)).alias("_reply"))
    joined = own.join(replies, F.col("conv_id") == F.col("_of"), "left")
    keep = F.coalesce(F.col("_last") - 1, F.size("turns"))
    reply = F.coalesce(F.col("_reply"), F.struct(F.lit("assistant").alias("role"), F.lit("").alias("text")))
    return joined.select("conv_id", F.col("turns").alias("chosen"),
                         F.concat(F.slice("turns", F.lit(1), keep), F.array(reply)).alias("rejected"))
