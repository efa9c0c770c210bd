"""Scores that follow the landed songs.

Scoring again from all songs at every trigger would read the whole table each time.
Instead each micro-batch lands its partial sums per (genre, decade, artist), and the
scores come from these; they equal a full run over the same songs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from perennial.operators.decades import artist_partials, decades_from_partials, genre_summary, merge_partials
from perennial.operators.scoring import score_genres, score_landing
from perennial.params import ScoringParams
from perennial.sources.tables import drop_folder, replace_days
from perennial.streaming.landing import BatchSink, folder_sink


def scores_from_partials(
    partials: DataFrame, params: ScoringParams = ScoringParams(), as_of: Column | None = None
) -> DataFrame:
    merged = merge_partials(partials)
    return score_genres(genre_summary(decades_from_partials(merged, params), params), params, as_of)


def merged_partials(spark: SparkSession, path: str, upto: int, snapshot_every: int = 100) -> DataFrame:
    """Partials of the batches up to ``upto``: the last snapshot before it and what came since.

    Batches are numbered without gaps, so the folders are named instead of listed: the work
    does not grow with the age of the stream.
    """
    last = max(upto - 1, 0) // snapshot_every * snapshot_every
    first = last + 1 if last else 0
    since = [f"{path}/batches/batch_id={number}" for number in range(first, upto + 1)]
    partials = spark.read.parquet(*since)
    if last:
        partials = partials.unionByName(spark.read.parquet(f"{path}/snapshots/batch_id={last}"))
    return merge_partials(partials)


def _drop_covered(spark: SparkSession, path: str, batch_id: int, snapshot_every: int) -> None:
    """Delete what the snapshot before this one holds. This one's batches stay for a repeat."""
    covered = batch_id - snapshot_every
    if covered < snapshot_every:
        return
    for number in range(max(covered - snapshot_every + 1, 0), covered + 1):
        drop_folder(spark, f"{path}/batches/batch_id={number}")
    if covered == snapshot_every:
        drop_folder(spark, f"{path}/batches/batch_id=0")
    drop_folder(spark, f"{path}/snapshots/batch_id={covered - snapshot_every}")


def rescoring_sink(
    spark: SparkSession,
    partials_path: str,
    scores_path: str,
    params: ScoringParams = ScoringParams(),
    profile: str = "lenient",
    as_of: Column | None = None,
    snapshot_every: int = 100,
) -> BatchSink:
    """Land the batch's partials, then replace the day's scores.

    Every ``snapshot_every`` batches the partials are merged into one table, so that a
    run reads that and a bounded number of batches however long the stream has run; batches
    that an earlier snapshot holds are deleted. Keep the number for the life of a root.
    Too few songs simply leave no genre that qualifies; the day's earlier scores stay.
    """
    land = folder_sink(f"{partials_path}/batches", lambda s: artist_partials(s, params, profile))
    keep = folder_sink(f"{partials_path}/snapshots")

    def write(songs: DataFrame, batch_id: int) -> None:
        land(songs, batch_id)
        partials = merged_partials(spark, partials_path, batch_id, snapshot_every)
        if batch_id and batch_id % snapshot_every == 0:
            keep(partials, batch_id)
            partials = spark.read.parquet(f"{partials_path}/snapshots/batch_id={batch_id}")
            _drop_covered(spark, partials_path, batch_id, snapshot_every)
        replace_days(score_landing(scores_from_partials(partials, params, as_of)), scores_path)

    return write
