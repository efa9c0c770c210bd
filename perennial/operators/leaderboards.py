"""Popularity per year for every value of eleven song attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perennial.operators.ranking import top_per_group

# The attributes, in report order.
ATTRIBUTES = (
    "artist", "top_genre", "bpm", "energy", "danceability", "loudness",
    "liveness", "valence", "length", "acousticness", "speechiness",
)


def attribute_year_sums(songs: DataFrame, ordered: bool = False) -> DataFrame:
    """Summed popularity per (attribute, year, value): one scan for all attributes.

    Tasks add up their own rows before the shuffle, so a value with a third of all
    songs arrives as one row per task. Whole numbers stay numbers until they are summed.
    """

    def cell(attribute: str) -> Column:
        whole = isinstance(songs.schema[attribute].dataType, T.IntegralType)
        text = F.lit(None) if whole else F.col(attribute)
        number = F.col(attribute) if whole else F.lit(None)
        return F.struct(text.cast("string").alias("text"), number.cast("long").alias("number"))

    long = songs.select("year", "popularity", *[cell(a).alias(a) for a in ATTRIBUTES]).unpivot(
        ["year", "popularity"], list(ATTRIBUTES), "attribute", "cell"
    )
    text, number = F.col("cell.text").alias("text"), F.col("cell.number").alias("number")
    summed = long.groupBy("attribute", "year", text, number).agg(F.sum("popularity").alias("total"))
    value = F.coalesce("text", F.col("number").cast("string")).alias("value")
    sums = summed.select("attribute", "year", value, "total")
    return sums.orderBy("attribute", "year", F.desc("total"), "value") if ordered else sums


def attribute_year_totals(sums: DataFrame) -> DataFrame:
    """Trend line: the yearly total of each attribute."""
    return sums.groupBy("attribute", "year").agg(F.sum("total").alias("total"))


def attribute_top(sums: DataFrame, n: int = 10, every: int = 1) -> DataFrame:
    """Best ``n`` values per attribute and year, optionally only years divisible by ``every``."""
    kept = sums.where(F.col("year") % every == 0) if every > 1 else sums
    best_first = [F.col("total").desc_nulls_last(), F.col("value").asc_nulls_first()]
    return top_per_group(kept, ["attribute", "year"], best_first, n)


def attribute_heatmap(sums: DataFrame, years: list[int], n: int = 15, min_values: int = 2) -> DataFrame:
    """Matrix of value by year over each year's best values, 0 where a value is not among them.

    ``years`` are the columns. An attribute with fewer than ``min_values`` values has
    no heat map.
    """
    cells = attribute_top(sums, n)
    matrix = cells.groupBy("attribute", "value").pivot("year", years).agg(F.sum("total")).fillna(0)
    # An attribute has at most n values per calendar year here.
    values = F.count(F.lit(1)).over(Window.partitionBy("attribute"))
    return matrix.withColumn("_values", values).where(F.col("_values") >= min_values).drop("_values")


def heatmap_rows(sums: DataFrame, years: Column, n: int = 15, min_values: int = 2) -> DataFrame:
    """The heat map as one row per cell, without asking the driver for its columns.

    ``years`` is an array, such as ``year_list`` gives. A value has one entry per calendar
    year at most, and an attribute ``n`` values per year.
    """
    entries = F.map_from_entries(F.collect_list(F.struct("year", "total")))
    shown = attribute_top(sums.where(F.col("year").isNotNull()), n).groupBy("attribute", "value").agg(
        entries.alias("_totals")
    )
    values = F.count(F.lit(1)).over(Window.partitionBy("attribute"))
    kept = shown.withColumn("_values", values).where(F.col("_values") >= min_values)
    return kept.select("attribute", "value", "_totals", F.explode(years).alias("year")).select(
        "attribute", "value", "year", F.coalesce(F.col("_totals")[F.col("year")], F.lit(0)).alias("total")
    )


def year_list(songs: DataFrame) -> Column:
    """All years of the songs as one array; there are no more than calendar years."""
    return songs.agg(F.sort_array(F.collect_set("year"))).scalar()


def heatmap_cells(matrix: DataFrame, years: list[int]) -> DataFrame:
    """The matrix as one row per cell."""
    return matrix.unpivot(["attribute", "value"], [str(y) for y in years], "year", "total").withColumn(
        "year", F.col("year").cast("int")
    )


def calendar_years(songs: DataFrame) -> list[int]:
    """Years present, for the heat map's columns; there are no more than calendar years."""
    rows = songs.select("year").where(F.col("year").isNotNull()).distinct().orderBy("year").collect()
    return [row["year"] for row in rows]
