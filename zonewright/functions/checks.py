"""Data checks that fail the job from inside the plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def require(value: Column, condition: Column, message: Column | str) -> Column:
    """``value`` where the condition holds, else the job fails with the message."""
    text = F.lit(message) if isinstance(message, str) else message
    return F.when(F.coalesce(condition, F.lit(False)), value).otherwise(F.raise_error(text))


def require_each(df: DataFrame, condition: Column, message: Column | str) -> DataFrame:
    """``df``, or a failed job at the first row that breaks the condition.

    A filter, so the check also holds for readers that use none of the checked columns.
    """
    return df.filter(require(F.lit(True), condition, message))


def require_none(df: DataFrame, offenders: DataFrame, message: str, limit: int = 20) -> DataFrame:
    """``df``, or a failed job when ``offenders`` (one text column) has rows.

    The check is a branch of its own that gives no rows, so it runs with ``df`` and
    also when ``df`` is empty. ``limit`` bounds the names in the message, which says
    how many more there are.
    """
    name = F.coalesce(F.col(offenders.columns[0]).cast("string"), F.lit("null"))
    every = offenders.select(name.alias("name")).distinct()
    found = every.orderBy("name").limit(limit)
    total = every.agg(F.count("*").alias("n")).scalar()
    more = F.when(total > limit, F.concat(F.lit(" and "), total - limit, F.lit(" more"))).otherwise("")
    # an aggregate without groups always gives one row; '' means nothing was found
    names = F.array_join(F.sort_array(F.collect_list("name")), ", ")
    listed = found.agg(names.alias("names")).withColumn("names", F.concat("names", more))
    failed = listed.filter(
        F.when(F.col("names") == "", F.lit(False)).otherwise(
            F.raise_error(F.concat(F.lit(f"{message}: "), F.col("names"))).cast("boolean")
        )
    )
    nothing = failed.select(
        *(F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields)
    )
    return df.unionByName(nothing)


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """``df``, or an error now when it is empty (stops at the first row found)."""
    if df.isEmpty():
        raise ValueError(message)
    return df
