"""Statistics per genre and year bucket, and their summary per genre.

The work runs in two steps that also serve the incremental job: partials per
(genre, decade, artist), then the roll-up to (genre, decade). The first step is
combined on the map side and spreads a genre that holds a third of all songs over
its artists; the second sees one row per artist. Counting artists needs no
DISTINCT, and years are counted with a bit mask, so no row is ever expanded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perennial.functions.buckets import year_bucket
from perennial.functions.numbers import exact_sample_std
from perennial.functions.text import genre_key
from perennial.operators.filters import FILTERS
from perennial.params import ScoringParams

_MASK_BITS = 60


def _year_masks(bucket_years: int) -> dict[str, Column]:
    """One bit per year of the bucket, in as many 60-bit words as it needs."""
    place = F.col("year") - F.col("decade").cast("int")
    masks = {}
    for word in range(-(-bucket_years // _MASK_BITS)):
        bit = place - word * _MASK_BITS
        flag = F.when(bit.between(0, _MASK_BITS - 1), F.call_function("shiftleft", F.lit(1).cast("long"), bit))
        masks[f"year_mask_{word}"] = F.coalesce(F.bit_or(flag), F.lit(0).cast("long"))
    return masks


def artist_partials(
    songs: DataFrame,
    params: ScoringParams = ScoringParams(),
    profile: str = "lenient",
    normalize_genre: bool = True,
) -> DataFrame:
    """Sums per (genre, decade, artist) of the songs that pass the filter profile."""
    genre = genre_key(F.col("genre")) if normalize_genre else F.col("genre")
    kept = FILTERS[profile](songs, params).select(
        genre.alias("genre"),
        year_bucket(F.col("year"), params.bucket_years).alias("decade"),
        "artist",
        "year",
        F.col("popularity").cast("long").alias("popularity"),
    )
    popularity = F.col("popularity")
    return kept.groupBy("genre", "decade", "artist").agg(
        F.count(F.lit(1)).alias("songs"),
        F.sum(popularity).alias("total"),
        F.sum(popularity * popularity).alias("squares"),
        F.max(popularity).alias("high"),
        F.min(popularity).alias("low"),
        *[mask.alias(name) for name, mask in _year_masks(params.bucket_years).items()],
    )


def merge_partials(partials: DataFrame) -> DataFrame:
    """Partials of several runs over disjoint songs, merged to one row per key."""
    masks = [c for c in partials.columns if c.startswith("year_mask_")]
    return partials.groupBy("genre", "decade", "artist").agg(
        F.sum("songs").alias("songs"),
        F.sum("total").alias("total"),
        F.sum("squares").alias("squares"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        *[F.bit_or(c).alias(c) for c in masks],
    )


def decades_from_partials(partials: DataFrame, params: ScoringParams = ScoringParams()) -> DataFrame:
    """Statistics per (genre, decade); buckets with too few songs are left out."""
    masks = [c for c in partials.columns if c.startswith("year_mask_")]
    sums = partials.groupBy("genre", "decade").agg(
        F.sum("songs").alias("songs_in_decade"),
        F.sum("total").alias("_total"),
        F.sum("squares").alias("_squares"),
        F.max("high").cast("int").alias("max_popularity"),
        F.min("low").cast("int").alias("min_popularity"),
        F.count("artist").alias("unique_artists"),
        *[F.bit_or(c).alias(c) for c in masks],
    )
    spread = exact_sample_std(F.col("songs_in_decade"), F.col("_total"), F.col("_squares"))
    years = sum((F.bit_count(c) for c in masks[1:]), F.bit_count(masks[0]))
    return sums.where(F.col("songs_in_decade") >= params.min_songs_per_bucket).select(
        "genre",
        "decade",
        (F.col("decade") + (params.bucket_years - 1)).alias("decade_end"),
        "songs_in_decade",
        F.round(F.col("_total") / F.col("songs_in_decade"), 2).alias("avg_popularity"),
        F.round(spread, 2).alias("popularity_std"),
        "max_popularity",
        "min_popularity",
        "unique_artists",
        years.cast("long").alias("years_covered"),
    )


def decade_stats(
    songs: DataFrame,
    params: ScoringParams = ScoringParams(),
    profile: str = "lenient",
    normalize_genre: bool = True,
) -> DataFrame:
    return decades_from_partials(artist_partials(songs, params, profile, normalize_genre), params)


def genre_summary(
    decades: DataFrame, params: ScoringParams = ScoringParams(), with_detail: bool = False
) -> DataFrame:
    """One row per genre over its decades.

    ``total_artists`` adds the artists of each decade, so one who is active in two
    decades counts twice. The detail list has one entry per decade, never more than
    there are buckets between the first and the last year.

    Scores that sit on a rounding tie must not depend on how partitions happen to
    arrive. So the mean adds the decades in their order, and the deviation of the
    two-decimal averages is taken from whole hundredths.
    """
    hundredths = F.round(F.col("avg_popularity") * 100).cast("long")
    entry = F.struct("decade", "avg_popularity", "songs_in_decade")
    detail = F.sort_array(F.collect_list(entry))
    total = F.aggregate(
        F.col("decade_data.avg_popularity"), F.lit(0.0), lambda total, mean: total + mean
    )
    spread = exact_sample_std(F.col("decades_active"), F.col("_total"), F.col("_squares"))
    per_genre = decades.groupBy("genre").agg(
        F.count(F.lit(1)).alias("decades_active"),
        F.min("decade").alias("first_decade"),
        F.max("decade").alias("last_decade"),
        F.sum("songs_in_decade").alias("total_songs"),
        F.sum("unique_artists").alias("total_artists"),
        F.sum(hundredths).alias("_total"),
        F.sum(hundredths * hundredths).alias("_squares"),
        F.max("avg_popularity").alias("peak_decade_popularity"),
        F.min("avg_popularity").alias("lowest_decade_popularity"),
        detail.alias("decade_data"),
    )
    summary = per_genre.where(
        (F.col("decades_active") >= params.min_buckets)
        & (F.col("total_songs") >= params.min_total_songs)
    ).withColumns(
        {
            "overall_avg_popularity": total / F.col("decades_active"),
            "decade_popularity_variance": F.round(spread / 100, 2),
        }
    )
    return summary.drop("_total", "_squares", *([] if with_detail else ["decade_data"]))


def decade_list_text(summary: DataFrame) -> DataFrame:
    """Size and readable form of the decade detail list."""
    entry = lambda d: F.format_string(
        "%d:%.2f:%d", d["decade"], d["avg_popularity"], d["songs_in_decade"]
    )
    return summary.select(
        "genre",
        F.size("decade_data").alias("decade_count"),
        F.array_join(F.transform("decade_data", entry), ";").alias("decade_text"),
    )
