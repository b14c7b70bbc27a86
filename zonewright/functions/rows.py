"""Row generation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def unnest(df: DataFrame, array: Column, name: str, keep: list[str]) -> DataFrame:
    """One row per non-null element of ``array``, next to the ``keep`` columns.

    A plain explode lets the optimizer infer size and null filters on its input
    and evaluate the array, often a whole clip, once more below. The outer form
    is not rewritten; its null rows are dropped after the fact.
    """
    return df.select(*keep, F.explode_outer(array).alias(name)).filter(F.col(name).isNotNull())
