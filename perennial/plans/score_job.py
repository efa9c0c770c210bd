"""Batch job: score the genres of a song table and replace the day's results.

    python -m perennial.plans.score_job --songs <parquet folder> --metrics <folder>
"""

from __future__ import annotations

import argparse

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from perennial.operators.filters import has_rows
from perennial.operators.reports import champion, genre_breakdown, latest_snapshot
from perennial.operators.scoring import score_landing, score_summary, timeless_scores
from perennial.params import ScoringParams
from perennial.session import build_session, tune
from perennial.sources import jdbc
from perennial.sources.tables import METRICS, replace_day


def run_scoring(
    spark: SparkSession,
    songs: DataFrame,
    metrics_path: str,
    params: ScoringParams = ScoringParams(),
    profile: str = "strict",
    normalize_genre: bool = False,
    as_of: Column | None = None,
) -> Row | None:
    """Score, land, and return the summary of what was landed; None without enough songs,
    which leaves the day's earlier rows as they are. With enough songs they are replaced
    even if no genre qualifies any more.

    The scores are computed once: everything after reads the landed rows.
    """
    if not has_rows(songs, params.min_total_songs):
        return None
    day = F.current_date() if as_of is None else as_of
    today = str(spark.range(1).select(day.cast("string")).first()[0])
    scores = timeless_scores(songs, params, profile, normalize_genre, F.lit(today).cast("date"))
    replace_day(score_landing(scores), metrics_path, today)
    return score_summary(latest_snapshot(spark.read.parquet(metrics_path))).first()


def champion_breakdown(
    spark: SparkSession, songs: DataFrame, metrics_path: str, params: ScoringParams = ScoringParams()
) -> DataFrame | None:
    """Decades of the best genre."""
    best = champion(latest_snapshot(spark.read.parquet(metrics_path))).first()
    return genre_breakdown(songs, best["genre"], params, any_case=True) if best else None


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--songs", help="parquet folder of landed songs")
    source.add_argument("--jdbc-url", help="database that holds the song table")
    parser.add_argument("--table", default="song_analytics")
    parser.add_argument("--jdbc-partitions", type=int, default=64)
    parser.add_argument("--metrics", required=True, help="folder of the score table")
    parser.add_argument(
        "--jdbc-target", help="database whose score table the day's rows are appended to, again by a rerun"
    )
    parser.add_argument("--profile", choices=("strict", "lenient"), default="strict")
    parser.add_argument("--normalize-genre", action="store_true")
    parser.add_argument("--as-of", help="analysis date, yyyy-mm-dd; today if left out")
    parser.add_argument("--shuffle-gb", type=int, help="size of the largest shuffle, to plan for it")
    options = parser.parse_args()

    spark = build_session("perennial-scores")
    if options.shuffle_gb:
        tune(spark, shuffle_bytes=options.shuffle_gb * 1024**3)
    if options.songs:
        songs = spark.read.parquet(options.songs)
    else:
        split = jdbc.id_split(spark, options.jdbc_url, options.table, options.jdbc_partitions)
        songs = jdbc.read_table(spark, options.jdbc_url, options.table, split)
    as_of = F.lit(options.as_of).cast("date") if options.as_of else None
    summary = run_scoring(
        spark,
        songs,
        options.metrics,
        profile=options.profile,
        normalize_genre=options.normalize_genre,
        as_of=as_of,
    )
    if summary and options.jdbc_target:
        today = latest_snapshot(spark.read.parquet(options.metrics))
        jdbc.append_table(today, options.jdbc_target, METRICS)
    print(summary.asDict() if summary else "not enough songs")


if __name__ == "__main__":
    main()
