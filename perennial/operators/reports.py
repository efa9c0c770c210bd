"""Report tables over scores, songs and trends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perennial.functions.buckets import period_label, year_bucket
from perennial.functions.text import genre_key, title_case
from perennial.operators.filters import of_genre, strict_filter, with_decade
from perennial.operators.ranking import rank_by_score, ranked_top_k, top_k
from perennial.params import ScoringParams

HISTOGRAM_BINS = 15


def _best_first() -> list[Column]:
    return [F.col("timeless_score").desc(), F.col("genre").asc()]


def one_decimal(number: Column) -> Column:
    return F.format_string("%.1f", number.cast("double"))


def latest_snapshot(metrics: DataFrame) -> DataFrame:
    """Scores of the newest analysis date; prunes to one partition of a landed table."""
    newest_day = metrics.agg(F.max("analysis_date").alias("day")).scalar()
    return metrics.where(F.col("analysis_date") == newest_day)


def ranked_snapshot(metrics: DataFrame) -> DataFrame:
    """All genres of the newest analysis with their place."""
    return rank_by_score(latest_snapshot(metrics))


def champion(metrics: DataFrame) -> DataFrame:
    """The best genre: its title and its score as text."""
    return top_k(metrics, 1, *_best_first()).select(
        "genre",
        title_case(F.col("genre")).alias("genre_title"),
        F.concat(one_decimal(F.col("timeless_score")), F.lit("/100")).alias("score_text"),
    )


def top_rankings(metrics: DataFrame, k: int = 10) -> DataFrame:
    return ranked_top_k(metrics, k, *_best_first()).select(
        "genre", "timeless_score", one_decimal(F.col("timeless_score")).alias("score_text"), "ranking"
    )


def summary_table(metrics: DataFrame, k: int = 6) -> DataFrame:
    return ranked_top_k(metrics, k, *_best_first()).select(
        "ranking",
        title_case(F.col("genre")).alias("genre_title"),
        *[
            one_decimal(F.col(c)).alias(f"{c}_text")
            for c in ("timeless_score", "consistency_score", "longevity_score")
        ],
        "decade_presence",
    )


def picker_options(metrics: DataFrame, k: int = 10) -> DataFrame:
    """Choices for a genre picker: the label shows the score."""
    label = F.format_string(
        "%s (Score: %.1f)", title_case(F.col("genre")), F.col("timeless_score").cast("double")
    )
    return top_k(metrics, k, *_best_first()).select(label.alias("label"), F.col("genre").alias("value"))


def score_components_long(metrics: DataFrame, k: int = 5) -> DataFrame:
    """The three headline scores of the best genres, one row per score."""
    names = ["timeless_score", "consistency_score", "longevity_score"]
    best = top_k(metrics, k, *_best_first()).select(
        "genre", *[F.col(c).cast("double").alias(c) for c in names]
    )
    return best.unpivot("genre", names, "metric", "score")


def score_histogram(metrics: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins from the lowest to the highest score, empty ones included.

    Scores are decimals of two places up to 100, so counting per value leaves at most
    10,001 rows; the bounds, the bins and the mean all come from those.
    """
    per_value = metrics.groupBy(F.col("timeless_score").cast("double").alias("score")).agg(
        F.count(F.lit(1)).alias("n")
    )
    everything = Window.partitionBy()
    low, high = F.min("score").over(everything), F.max("score").over(everything)
    binned = per_value.withColumns({"low": low, "high": high}).withColumn(
        "bin",
        F.when(F.col("high") == F.col("low"), F.lit(1)).otherwise(
            F.least(
                F.floor((F.col("score") - F.col("low")) * bins / (F.col("high") - F.col("low"))) + 1,
                F.lit(bins),
            ).cast("int")
        ),
    )
    per_bin = binned.groupBy("bin").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("score").cast("decimal(5,2)") * F.col("n")).alias("total"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )
    whole = per_bin.agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("counts"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        (F.sum("total").cast("double") / F.sum("n")).alias("mean_score"),
    ).where(F.col("low").isNotNull())
    last_bin = F.when(F.col("low") == F.col("high"), F.lit(1)).otherwise(F.lit(bins))
    width = (F.col("high") - F.col("low")) / bins
    return whole.withColumn("bin", F.explode(F.sequence(F.lit(1), last_bin))).select(
        "bin",
        (F.col("low") + width * (F.col("bin") - 1)).alias("bin_start"),
        (F.col("low") + width * F.col("bin")).alias("bin_end"),
        F.coalesce(F.try_element_at("counts", F.col("bin")), F.lit(0)).cast("long").alias("genre_count"),
        "mean_score",
    )


def genre_breakdown(
    songs: DataFrame, genre: str, params: ScoringParams = ScoringParams(), any_case: bool = False
) -> DataFrame:
    """One genre, decade by decade."""
    chosen = of_genre(strict_filter(songs, params), genre, any_case)
    return (
        with_decade(chosen, params)
        .groupBy("decade", "decade_label")
        .agg(
            F.count(F.lit(1)).alias("songs"),
            F.round(F.avg("popularity"), 1).alias("avg_pop"),
            F.count_distinct("artist").alias("artists"),
            F.min("year").alias("first_year"),
            F.max("year").alias("last_year"),
        )
        .orderBy("decade")
    )


def genre_timeline(
    songs: DataFrame,
    metrics: DataFrame,
    k: int | None = 10,
    first_year: int = 1980,
    last_year: int = 2024,
    period: int = 5,
    min_songs: int = 3,
) -> DataFrame:
    """The best genres over five-year periods, spelled as the songs spell them.

    ``k`` None takes all genres of ``metrics``. Two of them that differ in case match the
    same songs twice, as an inner join has it.
    """
    chosen = metrics if k is None else top_k(metrics, k, *_best_first())
    best = chosen.select(genre_key(F.col("genre")).alias("_key"))
    kept = songs.where(F.col("year").between(first_year, last_year)).select(
        "genre", "artist", "popularity", year_bucket(F.col("year"), period).cast("int").alias("period_start")
    )
    matched = kept.join(best, genre_key(F.col("genre")) == F.col("_key"))
    figures = matched.groupBy("genre", "period_start").agg(
        F.count(F.lit(1)).alias("song_count"),
        F.round(F.avg("popularity"), 1).alias("avg_popularity"),
        F.round(F.stddev_samp("popularity"), 1).alias("popularity_std"),
        F.max("popularity").alias("max_popularity"),
        F.min("popularity").alias("min_popularity"),
        F.count_distinct("artist").alias("unique_artists"),
    )
    end = F.col("period_start") + (period - 1)
    return (
        figures.where(F.col("song_count") >= min_songs)
        .withColumns({"period_end": end, "period_label": period_label(F.col("period_start"), end)})
        .orderBy("genre", "period_start")
    )


def timeline_of_genre(timeline: DataFrame, metrics: DataFrame, genre: str) -> DataFrame:
    """One genre of the timeline under its title; a genre without a score shows 0."""
    score = of_genre(metrics, genre, any_case=True).agg(F.max("timeless_score").alias("s")).scalar()
    heading = F.format_string(
        "%s - Timeless Journey (Score: %.1f/100)",
        title_case(F.lit(genre)),
        F.coalesce(score.cast("double"), F.lit(0.0)),
    )
    return of_genre(timeline, genre, any_case=True).withColumn("heading", heading)


def catalog_totals(songs: DataFrame, metrics: DataFrame) -> DataFrame:
    """Songs, genres, artists and analyzed genres in one row.

    Songs shrink to one row per (genre, artist) before anything distinct is counted. The
    analyzed genres are those of the newest date, counted per date in one pass.
    """
    pairs = songs.groupBy("genre", "artist").agg(F.count(F.lit(1)).alias("n"))
    per_day = metrics.groupBy("analysis_date").agg(F.count_distinct("genre").alias("n"))
    analyzed = per_day.agg(F.coalesce(F.max_by("n", "analysis_date"), F.lit(0)).alias("n")).scalar()
    return pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_songs"),
        F.count_distinct("genre").alias("total_genres"),
        F.count_distinct("artist").alias("total_artists"),
    ).withColumn("timeless_analyses", analyzed)


def year_range(songs: DataFrame) -> DataFrame:
    """Songs, genres and first and last year of the complete songs."""
    per_genre = songs.groupBy("genre").agg(
        F.count(F.lit(1)).alias("n"), F.min("year").alias("low"), F.max("year").alias("high")
    )
    return per_genre.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_songs"),
        F.count("genre").alias("unique_genres"),
        F.min("low").alias("first_year"),
        F.max("high").alias("last_year"),
    )


def genre_overview(songs: DataFrame) -> DataFrame:
    """Mean popularity, song count and latest year per genre, most popular first."""
    return (
        songs.groupBy("genre")
        .agg(
            F.avg("popularity").alias("avg_popularity"),
            F.count(F.lit(1)).alias("song_count"),
            F.max("year").alias("latest_year"),
        )
        .orderBy(F.desc("avg_popularity"), "genre")
    )

