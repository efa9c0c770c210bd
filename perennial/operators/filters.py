"""Row filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perennial.functions.buckets import decade_label, year_bucket
from perennial.params import ScoringParams


def strict_filter(songs: DataFrame, params: ScoringParams = ScoringParams()) -> DataFrame:
    """Complete songs only, with year and popularity in range."""
    present = songs.na.drop("any", subset=["genre", "year", "popularity", "title", "artist"])
    return present.where(
        F.col("year").between(params.year_start, params.year_end) & F.col("popularity").between(1, 100)
    )


def lenient_filter(songs: DataFrame, params: ScoringParams = ScoringParams()) -> DataFrame:
    """Songs with a genre, a year in range and any popularity above zero."""
    return songs.where(
        F.col("genre").isNotNull()
        & F.col("year").between(params.year_start, params.year_end)
        & (F.col("popularity") >= 1)
    )


FILTERS = {"strict": strict_filter, "lenient": lenient_filter}


def with_decade(songs: DataFrame, params: ScoringParams = ScoringParams()) -> DataFrame:
    decade = year_bucket(F.col("year"), params.bucket_years)
    return songs.withColumns({"decade": decade, "decade_label": decade_label(decade)})


def of_genre(frame: DataFrame, genre: str, any_case: bool = False) -> DataFrame:
    if any_case:
        return frame.where(F.lower("genre") == genre.lower())
    return frame.where(F.col("genre") == genre)


def has_rows(frame: DataFrame, n: int) -> bool:
    """Whether there are at least ``n`` rows, ``n`` being small.

    ``take`` reads one partition first and more only while rows are missing, where a
    limited count would start a task for every partition of the table.
    """
    return len(frame.select(F.lit(1)).take(n)) >= n


