"""All report tables at once, from the four landing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from perennial.operators import reports, song_events, trends
from perennial.operators.ranking import newest
from perennial.streaming.landing import latest_versions


def report_tables(
    songs: DataFrame,
    genre_trends: DataFrame,
    events: DataFrame,
    metrics: DataFrame,
    recent_songs: int | None = None,
    recent_trends: int | None = None,
    recent_events: int | None = None,
) -> dict[str, DataFrame]:
    """Name to frame; nothing runs until a frame is read.

    Reports are made from whole tables. A number restricts one to the newest rows of
    songs, trends or events; the timeline reads all songs in any case. Of trends that a
    stream landed (they have a ``batch_id``) the newest version of each window counts.
    """
    if "batch_id" in genre_trends.columns:
        genre_trends = latest_versions(genre_trends, ["genre", "analysis_window"])
    shown = newest(songs, "processed_at", recent_songs) if recent_songs else songs
    windows = newest(genre_trends, "analysis_window", recent_trends) if recent_trends else genre_trends
    live = newest(events, "created_at", recent_events) if recent_events else events
    scores = reports.latest_snapshot(metrics)
    features = trends.audio_features(shown)
    return {
        "ranking": reports.ranked_snapshot(metrics),
        "champion": reports.champion(scores),
        "top_rankings": reports.top_rankings(scores),
        "score_histogram": reports.score_histogram(scores),
        "score_components": reports.score_components_long(scores),
        "summary": reports.summary_table(scores),
        "genre_choices": reports.picker_options(scores),
        "genre_timeline": reports.genre_timeline(songs, scores),
        "genre_trends": trends.trend_rollup(windows),
        "popularity_over_time": trends.popularity_over_time(shown),
        "audio_features": features,
        "audio_features_long": trends.audio_features_long(features),
        "event_types": song_events.event_type_counts(live),
        "event_details": song_events.event_details(live, shown),
        "totals": reports.catalog_totals(shown, metrics),
    }
