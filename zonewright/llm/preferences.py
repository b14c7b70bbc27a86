"""Preference formatting: a shared prompt and two masked completions for each pair.

The turns that the chosen and the rejected conversation have in common at their start are
rendered once, as the prompt. The rest of each is its completion. A completion's mask lists the
character ranges of its assistant turns, end mark included; only these are learned from.

Defined results: a pair with one side only has no row; equal conversations have empty
completions; a null role or text is rendered as empty but equals only null; turns are ordered by
their number, then role, then text, and repeated rows are turns of their own; a null pair id
is one pair; an empty table gives an empty table; other columns are ignored. A conversation is
one string of the result, so its turns meet in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of a rendered turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
LEARNED = "assistant"


def _rendered(turns: str) -> str:
    return (
        f"transform({turns}, t -> concat('{OPEN}', coalesce(t.role, ''), '\\n', "
        f"coalesce(t.text, ''), '{CLOSE}'))"
    )


def _mask(turns: str) -> Column:
    """Character ranges of the learned turns of a completion."""
    parts = f"zip_with({turns}, {_rendered(turns)}, (t, s) -> struct(t.role AS role, length(s) AS n))"
    walked = (
        f"aggregate({parts}, named_struct('at', 0, 'spans', "
        "CAST(array() AS array<struct<start:int,end:int>>)), (a, p) -> named_struct("
        f"'at', a.at + p.n, 'spans', IF(p.role <=> '{LEARNED}', "
        "array_append(a.spans, named_struct('start', a.at, 'end', a.at + p.n)), a.spans)), "
        "a -> a.spans)"
    )
    return F.expr(walked)


def format_preferences(
    chosen: DataFrame,
    rejected: DataFrame,
    pair_col: str = "pair_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``pair_id``, ``prompt``, ``prompt_turns``, ``chosen``, ``rejected`` and both masks."""

    def side(turns: DataFrame, is_chosen: bool) -> DataFrame:
        return turns.select(
            F.col(pair_col).alias("pair_id"),
            F.struct(
                F.col(turn_col).alias("turn"),
                F.col(role_col).alias("role"),
                F.col(text_col).alias("text"),
            ).alias("_turn"),
            F.lit(is_chosen).alias("_chosen"),
        )

    both = (
        side(chosen, True)
        .unionByName(side(rejected, False))
        .groupBy("pair_id")
        .agg(
            F.sort_array(F.collect_list(F.when(F.col("_chosen"), F.col("_turn")))).alias("_c"),
            F.sort_array(F.collect_list(F.when(~F.col("_chosen"), F.col("_turn")))).alias("_r"),
        )
        .filter("size(_c) > 0 AND size(_r) > 0")
    )
    shorter = "least(size(_c), size(_r))"
    equal = (
        f"zip_with(slice(_c, 1, {shorter}), slice(_r, 1, {shorter}), "
        "(x, y) -> x.role <=> y.role AND x.text <=> y.text)"
    )
    common = f"coalesce(nullif(array_position({equal}, false), 0) - 1, {shorter})"
    parted = both.withColumn("prompt_turns", F.expr(common).cast("int")).withColumns(
        {
            "_p": F.expr("slice(_c, 1, prompt_turns)"),
            "_c": F.expr("slice(_c, prompt_turns + 1, size(_c) - prompt_turns)"),
            "_r": F.expr("slice(_r, prompt_turns + 1, size(_r) - prompt_turns)"),
        }
    )
    return parted.select(
        "pair_id",
        "prompt_turns",
        F.expr(f"array_join({_rendered('_p')}, '')").alias("prompt"),
        F.expr(f"array_join({_rendered('_c')}, '')").alias("chosen"),
        F.expr(f"array_join({_rendered('_r')}, '')").alias("rejected"),
        _mask("_c").alias("chosen_mask"),
        _mask("_r").alias("rejected_mask"),
    )


def echo_negatives(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected conversations from single ones.

    The chosen side ends with the last assistant turn. The rejected side is the same up to
    there, but in that turn the assistant only repeats the turn before it (nothing, if there
    is none). Conversations without an assistant turn give no pair.
    """
    from pyspark.sql import Window

    plain = conversations.select(
        F.col(conv_col).alias("pair_id"),
        F.col(turn_col).alias("turn"),
        F.col(role_col).alias("role"),
        F.col(text_col).alias("text"),
    )
    order = Window.partitionBy("pair_id").orderBy("turn", "role", "text")
    whole = Window.partitionBy("pair_id")
    placed = (
        plain.withColumns(
            {"_at": F.row_number().over(order), "_before": F.lag("text").over(order)}
        )
        .withColumn("_last", F.max(F.when(F.col("role") == LEARNED, F.col("_at"))).over(whole))
        .filter("_at <= _last")
    )
    rejected = placed.withColumn(
        "text", F.when(F.col("_at") == F.col("_last"), F.col("_before")).otherwise(F.col("text"))
    )
    columns = ["pair_id", F.col("_at").alias("turn"), "role", "text"]
    return placed.select(*columns), rejected.select(*columns)
