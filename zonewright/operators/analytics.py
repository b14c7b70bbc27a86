"""Reports on finished products: units, trends, rankings, version comparison.

Input rows are (zone_id, zone_name, year, indicator, value).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from zonewright.session import stored

# Square metres per unit.
UNIT_M2 = {"m²": 1.0, "km²": 1e6, "million ha": 1e10}


def with_units(df: DataFrame, unit: str = "km²", value: str = "value") -> DataFrame:
    """Adds ``value_display``: square metres in another unit."""
    return df.withColumn("value_display", F.col(value) / UNIT_M2[unit])


def time_filter(df: DataFrame, year: int) -> DataFrame:
    """Values of one year, by name and zone."""
    return df.filter(F.col("year") == year).orderBy("zone_name", "zone_id", "indicator")


def _latest(df: DataFrame) -> DataFrame:
    return df.filter(F.col("year") == df.agg(F.max("year")).scalar())


def summary(df: DataFrame, value: str = "value") -> DataFrame:
    """One row of figures from one pass: per zone and year, then per year, then over the years.

    A zone counts in the first of its years, so the zones of all years add up.
    """
    per_zone = df.groupBy("zone_id", "year").agg(
        F.count("*").alias("n"), F.sum(value).alias("total"), F.max(value).alias("top")
    )
    place = F.row_number().over(Window.partitionBy("zone_id").orderBy("year"))
    first = (F.col("zone_id").isNotNull() & (place == 1)).cast("long")
    per_year = per_zone.withColumn("first", first).groupBy("year").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("top").alias("top"), F.sum("first").alias("first")
    )
    return per_year.agg(
        F.sum("n").alias("n_rows"),
        F.min("year").alias("year_first"),
        F.max("year").alias("year_last"),
        F.count("*").alias("n_years"),
        F.round(F.max_by("total", "year"), 3).alias("latest_total"),
        F.round(F.max("top"), 3).alias("max_value"),
        F.coalesce(F.sum("first"), F.lit(0)).alias("n_zones"),
    )


def top_latest(df: DataFrame, k: int = 10, value: str = "value") -> DataFrame:
    """The k highest values of the latest year."""
    return (
        _latest(df)
        .orderBy(F.col(value).desc_nulls_last(), "zone_id", "indicator")
        .limit(k)
        .select("zone_id", "zone_name", "indicator", value)
    )


def annual_totals(df: DataFrame, value: str = "value") -> DataFrame:
    return df.groupBy("year").agg(F.sum(value).alias("total"))


def top_series(df: DataFrame, k: int = 5, value: str = "value") -> DataFrame:
    """Year x top-k zones of the latest year, as columns ``top_1`` .. ``top_k``.

    Zones are ranked by their latest total; ``top_latest`` names them. The rows are read once:
    totals per zone and year are kept, and ranked and laid out from there.
    """
    totals = stored(df.groupBy("zone_id", "year").agg(F.sum(value).alias("_total")))
    ranked = (
        _latest(totals)
        .orderBy(F.col("_total").desc_nulls_last(), "zone_id")
        .limit(k)
    )
    order = F.sort_array(F.collect_list(F.struct(-F.col("_total"), "zone_id")))
    ids = ranked.agg(F.transform(order, lambda s: s["zone_id"]).alias("ids")).scalar()
    rank = F.array_position(ids, F.col("zone_id"))
    return (
        totals.withColumn("_rank", rank)
        .filter(F.col("_rank") > 0)
        .groupBy("year")
        .pivot("_rank", list(range(1, k + 1)))
        .agg(F.sum("_total"))
        .withColumnsRenamed({str(i): f"top_{i}" for i in range(1, k + 1)})
    )


def compare_versions(
    a: DataFrame, b: DataFrame, on: list[str], unit: str = "km²", value: str = "value"
) -> DataFrame:
    """Values of two products side by side; rows null or 0 in either are left out."""
    scale = UNIT_M2[unit]
    left = a.select(*on, (F.col(value) / scale).alias("_a")).filter(F.col("_a") != 0)
    right = b.select(*on, (F.col(value) / scale).alias("_b")).filter(F.col("_b") != 0)
    difference = F.round(F.col("_b") - F.col("_a"), 3)
    return left.join(right, on).select(
        *on,
        F.round("_a", 3).alias("value_a"),
        F.round("_b", 3).alias("value_b"),
        difference.alias("diff"),
        F.try_divide(difference, F.round("_a", 3)).alias("rel_diff"),
    )


def top_diff(compared: DataFrame, column: str = "diff", k: int = 5, keys=("zone_id",)) -> DataFrame:
    """The k rows with the largest difference."""
    return compared.orderBy(F.col(column).desc_nulls_last(), *keys).limit(k)
