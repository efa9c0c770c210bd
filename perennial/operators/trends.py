"""Genre trends over fixed time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perennial.functions.buckets import time_bucket
from perennial.operators.ranking import top_k


def genre_trends(
    songs: DataFrame,
    moment: str = "processed_at",
    length: str = "5 minutes",
    watermark: str | None = None,
    exact_artists: bool = False,
) -> DataFrame:
    """Song count and popularity figures per genre and tumbling window.

    Works on streams too; there artists can only be counted approximately, and a
    watermark lets old windows leave the state.
    """
    if watermark:
        songs = songs.withWatermark(moment, watermark)
    count_artists = F.count_distinct if exact_artists else F.approx_count_distinct
    return (
        songs.where(F.col("genre").isNotNull())
        .groupBy("genre", F.window(moment, length).alias("time_window"))
        .agg(
            F.count(F.lit(1)).alias("song_count"),
            F.avg("popularity").alias("avg_popularity"),
            F.stddev_samp("popularity").alias("std_popularity"),
            F.max("popularity").alias("max_popularity"),
            F.min("popularity").alias("min_popularity"),
            count_artists("artist").alias("unique_artists"),
        )
    )


def trend_partials(
    songs: DataFrame, moment: str = "processed_at", length: str = "5 minutes"
) -> DataFrame:
    """Sums per genre and window from which ``merge_trends`` makes the figures.

    Sums of different batches add up in any order, so a stream that lands them needs no
    watermark and loses no late song. Artists are an HLL sketch, which merges as well.
    """
    popularity = F.col("popularity").cast("long")
    return (
        songs.where(F.col("genre").isNotNull())
        .groupBy("genre", F.window(moment, length).alias("time_window"))
        .agg(
            F.count(F.lit(1)).alias("song_count"),
            F.count("popularity").alias("known"),
            F.sum(popularity).alias("total"),
            F.sum(popularity * popularity).alias("squares"),
            F.max("popularity").alias("max_popularity"),
            F.min("popularity").alias("min_popularity"),
            F.hll_sketch_agg("artist").alias("artists"),
        )
    )


def added_partials(partials: DataFrame) -> DataFrame:
    """One row of sums per genre and window, for partials to be merged again."""
    return partials.groupBy("genre", "time_window").agg(
        *[F.sum(name).alias(name) for name in ("song_count", "known", "total", "squares")],
        F.max("max_popularity").alias("max_popularity"),
        F.min("min_popularity").alias("min_popularity"),
        F.hll_union_agg("artists").alias("artists"),
    )


def merge_trends(partials: DataFrame) -> DataFrame:
    """Figures of ``genre_trends`` from landed partials; artists are estimated."""
    merged = added_partials(partials)
    known = F.col("known")
    spread = (known * F.col("squares") - F.col("total") * F.col("total")).cast("double")
    deviation = F.when(known > 1, F.sqrt(F.try_divide(spread, known.cast("double") * (known - 1))))
    return merged.select(
        "genre",
        "time_window",
        "song_count",
        F.try_divide(F.col("total").cast("double"), known).alias("avg_popularity"),
        deviation.alias("std_popularity"),
        "max_popularity",
        "min_popularity",
        F.hll_sketch_estimate("artists").alias("unique_artists"),
    )


def trend_landing(trends: DataFrame) -> DataFrame:
    """Columns of ``genre_trends``."""
    figure = "decimal(5,2)"
    return trends.select(
        "genre",
        F.col("avg_popularity").cast(figure).alias("avg_popularity"),
        F.col("song_count").cast("long").alias("song_count"),
        F.col("time_window.start").alias("analysis_window"),
        F.col("std_popularity").cast(figure).alias("std_popularity"),
        F.col("max_popularity").cast("int").alias("max_popularity"),
        F.col("min_popularity").cast("int").alias("min_popularity"),
        F.col("unique_artists").cast("long").alias("unique_artists"),
    )


def trend_rollup(trends: DataFrame, k: int = 10) -> DataFrame:
    """Genres with the best mean of their window averages; windows weigh the same.

    Landed averages are decimals: they are added exactly and divided once.
    """
    mean = F.try_divide(F.sum("avg_popularity").cast("double"), F.count("avg_popularity"))
    rolled = trends.groupBy("genre").agg(
        mean.alias("avg_popularity"), F.sum("song_count").alias("song_count")
    )
    return top_k(rolled, k, F.desc("avg_popularity"), F.col("genre"))


def top_genres_by_rows(songs: DataFrame, k: int = 5) -> DataFrame:
    """Genres with the most songs; songs without a genre do not count."""
    counted = songs.where(F.col("genre").isNotNull()).groupBy("genre").count()
    return top_k(counted, k, F.desc("count"), F.col("genre"))


def popularity_over_time(
    songs: DataFrame, moment: str = "processed_at", length: str = "10 minutes", k: int = 5
) -> DataFrame:
    """Mean popularity per time bucket for the genres with the most songs.

    Songs are summed once per bucket and genre; the leaders come from the same sums. Both
    uses need all columns of the sums (genres differ, so what follows them in the order
    decides nothing): the shuffled sums are then the same and the songs are read once.
    """
    sums = (
        songs.where(F.col("genre").isNotNull())
        .groupBy(time_bucket(F.col(moment), length).alias("time_bucket"), "genre")
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.sum("popularity").cast("double").alias("_sum"),
            F.count("popularity").alias("_known"),
        )
    )
    counted = sums.groupBy("genre").agg(
        F.sum("_rows").alias("count"), F.sum("_sum").alias("_sum"), F.sum("_known").alias("_known")
    )
    order = [F.desc("count"), F.col("genre"), F.col("_sum"), F.col("_known")]
    leaders = top_k(counted, k, *order).select("genre")
    mean = F.when(F.col("_rows") > 0, F.try_divide("_sum", F.col("_known")))
    # A semi join would be moved below the sums, which would then differ.
    return sums.join(leaders, "genre").select("time_bucket", "genre", mean.alias("popularity"))


AUDIO_FEATURES = ("energy", "danceability", "valence", "acousticness")


def audio_features(songs: DataFrame, k: int = 5) -> DataFrame:
    """Mean audio features of the genres with the most songs, in one pass."""
    means = (
        songs.where(F.col("genre").isNotNull())
        .groupBy("genre")
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.avg(feature).alias(feature) for feature in AUDIO_FEATURES],
        )
    )
    return top_k(means, k, F.desc("_rows"), F.col("genre")).drop("_rows")


def audio_features_long(features: DataFrame) -> DataFrame:
    return features.unpivot("genre", list(AUDIO_FEATURES), "feature", "mean_value")
