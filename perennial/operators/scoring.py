"""Timeless score: components, penalties, tier and landing rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perennial import params as fixed
from perennial.operators.decades import decade_stats, genre_summary
from perennial.params import ScoringParams


def _steps(value: Column, bounds, default, below: bool) -> Column:
    """First matching step of (bound, result), ``below`` or else at least the bound."""
    tests = [((value < b) if below else (value >= b), F.lit(r)) for b, r in bounds]
    first, *others = tests
    chain = reduce(lambda c, t: c.when(*t), others, F.when(*first))
    return chain.otherwise(F.lit(default))


def component_scores(summary: DataFrame, params: ScoringParams = ScoringParams()) -> DataFrame:
    """The four rounded components, the penalties and the tier per genre."""
    mean, spread = F.col("overall_avg_popularity"), F.col("decade_popularity_variance")
    peak, low = F.col("peak_decade_popularity"), F.col("lowest_decade_popularity")
    decades, total = F.col("decades_active"), F.col("total_songs")
    last = F.col("last_decade")
    years = last - F.col("first_decade")

    presence = F.least(F.lit(100.0), decades * 100.0 / params.max_buckets)
    consistency = (
        F.when((mean > 0) & (spread > 0), F.greatest(F.lit(0.0), 100 - spread / mean * 300))
        .when(spread == 0, F.lit(85.0))
        .otherwise(F.lit(0.0))
    )
    volume = F.least(F.lit(10.0), F.log10(total) * 3)
    longevity = F.least(F.lit(100.0), years / 50.0 * 60 + decades * 5 + volume)
    stability = F.when(
        peak > low, F.greatest(F.lit(0.0), 100 - (peak - low) / mean * 200)
    ).otherwise(F.lit(70.0))
    aged = [(params.year_end - ago, penalty) for ago, penalty in fixed.RECENCY_PENALTIES]

    return summary.withColumns(
        {
            "time_span_decades": years / params.bucket_years + 1,
            "decade_presence_score": F.round(presence, 1),
            "consistency_score": F.round(consistency, 1),
            "longevity_score": F.round(longevity, 1),
            "stability_score": F.round(stability, 1),
            "popularity_penalty": _steps(mean, fixed.POPULARITY_PENALTIES, 0, below=True),
            "recency_penalty": _steps(last, aged, 0, below=True),
            "popularity_tier": _steps(mean, fixed.POPULARITY_TIERS, fixed.LOWEST_TIER, below=False),
        }
    )


def raw_score() -> Column:
    """Weighted components minus penalties, unrounded and never negative.

    The presence part is an exact decimal product before it joins the sum: scores
    that fall on a rounding tie come out the same on every engine.
    """
    presence = F.col("decade_presence_score").cast("decimal(5,1)") * F.lit(fixed.PRESENCE_WEIGHT)
    weighted = (
        F.col("consistency_score") * fixed.CONSISTENCY_WEIGHT
        + F.col("longevity_score") * fixed.LONGEVITY_WEIGHT
        + F.col("stability_score") * fixed.STABILITY_WEIGHT
        + presence.cast("double")
    )
    return F.greatest(F.lit(0.0), weighted - F.col("popularity_penalty") - F.col("recency_penalty"))


def score_genres(
    summary: DataFrame, params: ScoringParams = ScoringParams(), as_of: Column | None = None
) -> DataFrame:
    """Scores of the genres that qualify, one row each, in no particular order."""
    scored = component_scores(summary, params).where(
        (F.col("consistency_score") > 0)
        & (F.col("longevity_score") > 0)
        & (F.col("decades_active") >= params.min_buckets)
    )
    return scored.select(
        "genre",
        F.col("decades_active").alias("decade_presence"),
        "time_span_decades",
        "total_songs",
        "total_artists",
        F.round("overall_avg_popularity", 1).alias("avg_popularity"),
        "popularity_tier",
        "decade_presence_score",
        "consistency_score",
        "longevity_score",
        "stability_score",
        "popularity_penalty",
        "recency_penalty",
        F.round(raw_score(), 1).alias("timeless_score"),
        (F.current_date() if as_of is None else as_of).alias("analysis_date"),
        F.lit(params.bucket_years).alias("analysis_period_years"),
    )


def timeless_scores(
    songs: DataFrame,
    params: ScoringParams = ScoringParams(),
    profile: str = "lenient",
    normalize_genre: bool = True,
    as_of: Column | None = None,
) -> DataFrame:
    """From songs to scores."""
    decades = decade_stats(songs, params, profile, normalize_genre)
    return score_genres(genre_summary(decades, params), params, as_of)


def by_score(scores: DataFrame) -> DataFrame:
    """Best first by the unrounded score; the genre decides ties."""
    return scores.orderBy(raw_score().desc(), F.col("genre"))


def score_landing(scores: DataFrame) -> DataFrame:
    """Columns of ``timeless_genre_metrics``; two of them keep the table's older names."""
    score = "decimal(5,2)"
    return scores.select(
        "genre",
        "analysis_date",
        F.col("analysis_period_years").cast("int").alias("analysis_period_years"),
        F.col("timeless_score").cast(score).alias("timeless_score"),
        F.col("consistency_score").cast(score).alias("consistency_score"),
        F.col("longevity_score").cast(score).alias("longevity_score"),
        F.col("stability_score").cast(score).alias("variance_score"),
        F.col("decade_presence_score").cast(score).alias("peak_stability"),
        F.col("decade_presence").cast("int").alias("decade_presence"),
        F.col("time_span_decades").cast("int").alias("year_span"),
        F.col("total_songs").cast("long").alias("total_songs"),
        F.col("total_artists").cast("long").alias("total_unique_artists"),
        F.lit(None).cast("string").alias("period_stats"),
        F.lit(None).cast("string").alias("analysis_metadata"),
        F.current_timestamp().alias("created_at"),
    )


def score_summary(scores: DataFrame) -> DataFrame:
    """How many genres scored, the best score and the mean, in one pass.

    Landed scores have two decimals, so they are added exactly.
    """
    total = F.sum(F.col("timeless_score").cast("decimal(5,2)")).cast("double")
    return scores.agg(
        F.count(F.lit(1)).alias("total_analyzed"),
        F.max("timeless_score").alias("max_score"),
        F.try_divide(total, F.count(F.lit(1))).alias("avg_score"),
    )
