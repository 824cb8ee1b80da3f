"""Preference pairs from conversations, in SQL functions.

A pair is a chosen and a rejected conversation.  Their longest common prefix
of turns (equal role and text, null equal to null) is rendered once, as the
prompt; what follows on either side is that side's completion.  A completion
is a list of segments with a flag: the content and end mark of assistant turns
are trained on, everything else (other roles' turns, headers) is masked.

Rendering: ``<|im_start|>role\\ncontent<|im_end|>\\n`` per turn; a ``<|`` inside
a role or content becomes ``< |``, so texts cannot forge a turn.

Defined cases: turns are ordered by number, then role, then text, nulls first,
and repeated turns stay; a null role reads ``unknown``, a null text is empty; rows
without a conversation id belong to no pair; a pair needs turns on both sides,
others give no row; equal conversations give a prompt and two empty
completions; an empty table gives an empty result; other columns are ignored.
The turns of one pair meet in one task, as they do in its result row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed marks of the chat format.
START, END = "<|im_start|>", "<|im_end|>"
TRAINED_ROLE = "assistant"


def _head(turn: str) -> str:
    return f"concat('{START}', {turn}.role, '\\n')"


def _body(turn: str) -> str:
    return f"concat({turn}.text, '{END}\\n')"


def _segments(turns: str) -> str:
    return f"""flatten(transform({turns}, t -> array(
        named_struct('text', {_head('t')}, 'train', false),
        named_struct('text', {_body('t')}, 'train', t.role = '{TRAINED_ROLE}'))))"""


def format_pairs(turns: DataFrame) -> DataFrame:
    """``pair_id, n_prompt_turns, prompt, chosen, rejected, chosen_segments,
    rejected_segments`` from ``turns(pair_id, is_chosen, turn, role, text)``."""
    clean = lambda c, default: F.replace(F.coalesce(F.col(c), F.lit(default)), F.lit("<|"), F.lit("< |"))
    one = F.struct(
        F.col("turn").alias("turn"),
        F.col("role").alias("own_role"),
        F.col("text").alias("own_text"),
        clean("role", "unknown").alias("role"),
        clean("text", "").alias("text"),
    )
    sides = (
        turns.where("pair_id is not null and is_chosen is not null")
        .groupBy("pair_id")
        .agg(
            F.array_sort(F.collect_list(F.when(F.col("is_chosen"), one)), ORDER).alias("c"),
            F.array_sort(F.collect_list(F.when(~F.col("is_chosen"), one)), ORDER).alias("r"),
        )
        .where("size(c) > 0 and size(r) > 0")
    )
    same = """zip_with(slice(c, 1, least(size(c), size(r))), slice(r, 1, least(size(c), size(r))),
        (a, b) -> a.own_role <=> b.own_role and a.own_text <=> b.own_text)"""
    cut = (
        sides.withColumn("n", F.expr(f"array_position({same}, false)"))
        .withColumn("n", F.expr("if(n = 0, least(size(c), size(r)), int(n - 1))"))
        .select(
            "pair_id",
            F.col("n").cast("long").alias("n_prompt_turns"),
            F.expr(f"array_join(transform(slice(c, 1, n), t -> concat({_head('t')}, {_body('t')})), '')").alias("prompt"),
            F.expr(_segments("slice(c, n + 1, size(c))")).alias("chosen_segments"),
            F.expr(_segments("slice(r, n + 1, size(r))")).alias("rejected_segments"),
        )
    )
    joined = lambda s: F.expr(f"array_join(transform({s}_segments, x -> x.text), '')").alias(s)
    return cut.select(
        "pair_id",
        "n_prompt_turns",
        "prompt",
        joined("chosen"),
        joined("rejected"),
        "chosen_segments",
        "rejected_segments",
    )


def ORDER(a, b):
    """Compare two turns: by number, role and text, nulls first."""

    def rank(field: str):
        x, y = a[field], b[field]
        return (
            F.when(x.isNull() & y.isNull(), 0)
            .when(x.isNull() | (x < y), -1)
            .when(y.isNull() | (x > y), 1)
            .otherwise(0)
        )

    turn, role = rank("turn"), rank("own_role")
    return F.when(turn != 0, turn).when(role != 0, role).otherwise(rank("own_text"))


def trained_chars(segments: str) -> str:
    """SQL for the characters of the trained segments."""
    return f"aggregate(filter({segments}, s -> s.train), 0L, (n, s) -> n + length(s.text))"
