"""Sinks for micro-batches.

Each batch overwrites a folder of its own number. A batch that is run again after a
failure replaces its first attempt, and an error in the sink stops the query
instead of losing the batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from perennial.sources.jdbc import append_table

Shape = Callable[[DataFrame], DataFrame]
BatchSink = Callable[[DataFrame, int], None]

# Trigger periods.
TREND_TRIGGER = "30 seconds"
SONG_TRIGGER = "10 seconds"
EVENT_TRIGGER = "5 seconds"
SCORE_TRIGGER = "60 seconds"


def folder_sink(path: str, shape: Shape | None = None) -> BatchSink:
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = shape(batch) if shape else batch
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def jdbc_sink(url: str, table: str, shape: Shape | None = None, **options: str) -> BatchSink:
    """Append to a relational table: a batch run again is appended again, so give the
    table a key where that matters."""

    def write(batch: DataFrame, _batch_id: int) -> None:
        append_table(shape(batch) if shape else batch, url, table, **options)

    return write


def each(*sinks: BatchSink) -> BatchSink:
    """Every sink in turn."""

    def write(batch: DataFrame, batch_id: int) -> None:
        for sink in sinks:
            sink(batch, batch_id)

    return write


def start_query(
    stream: DataFrame,
    sink: BatchSink,
    checkpoint: str,
    every: str | None = None,
    output_mode: str = "append",
    name: str | None = None,
) -> StreamingQuery:
    """Start a stream into a sink; without ``every`` it reads what is there and ends."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = stream.writeStream.foreachBatch(sink).outputMode(output_mode).trigger(**trigger)
    if name:
        writer = writer.queryName(name)
    return writer.option("checkpointLocation", checkpoint).start()


def landed(spark: SparkSession, path: str) -> DataFrame:
    """All landed rows with the number of their batch."""
    return spark.read.parquet(path)


def latest_versions(landed_rows: DataFrame, keys: list[str]) -> DataFrame:
    """Newest version per key, for results that a stream updates as it goes.

    A plain aggregate: tasks keep one version per key before the shuffle.
    """
    values = [c for c in landed_rows.columns if c not in (*keys, "batch_id")]
    newest = F.max_by(F.struct(*values), "batch_id").alias("_newest")
    return landed_rows.groupBy(*keys).agg(newest).select(*keys, "_newest.*")


def compact(spark: SparkSession, path: str, target: str, keys: list[str] | None = None) -> None:
    """Rewrite a landing folder of many small batches as one table; with ``keys`` only
    the newest versions are kept. Run it while no query writes to ``path``."""
    rows = landed(spark, path)
    rows = latest_versions(rows, keys) if keys else rows.drop("batch_id")
    rows.write.mode("errorifexists").parquet(target)
