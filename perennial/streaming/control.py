"""Looking after running queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def with_ticks(stream: DataFrame, moment: str | None = None) -> DataFrame:
    """The stream and one row a second with nothing in it, but the time in ``moment``.

    Spark runs a batch only when a source has new rows; with these, sinks and watermarks
    that follow the wall clock go on while the stream itself is idle.
    """
    ticks = stream.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load()
    empty = [
        (F.col("timestamp") if field.name == moment else F.lit(None)).cast(field.dataType).alias(field.name)
        for field in stream.schema.fields
    ]
    return stream.unionByName(ticks.select(*empty))


def health(queries: list[StreamingQuery]) -> list[dict]:
    """State of each query: whether it runs, its failure, its last progress."""
    states = []
    for query in queries:
        failure = query.exception()
        states.append(
            {
                "name": query.name,
                "active": query.isActive,
                "failure": str(failure) if failure else None,
                "progress": query.lastProgress,
            }
        )
    return states


def stopped(queries: list[StreamingQuery]) -> list[StreamingQuery]:
    return [query for query in queries if not query.isActive]


def stop_all(spark: SparkSession) -> None:
    for query in spark.streams.active:
        query.stop()


def finish(query: StreamingQuery, timeout_seconds: int | None = None) -> None:
    """Wait for a query that ends by itself; a failed one raises its error here."""
    if timeout_seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_seconds):
        query.stop()
        raise TimeoutError(f"query {query.name or query.id} was still running")
