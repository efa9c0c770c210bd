"""Progress and failures of running queries, landed as a table."""

from __future__ import annotations

import datetime
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

PROGRESS = (
    "moment timestamp, name string, query_id string, run_id string, kind string, batch_id long, "
    "input_rows long, milliseconds long, state_rows long, late_rows long, watermark string, failure string"
)


class ProgressLog(StreamingQueryListener):
    """Lands one row when a query starts, after each of its batches and when it ends.

    Rows are held until there are ``every`` of them or a query ends; a lost driver costs
    those. Rows are a few hundred bytes per batch, whatever the size of the batch. Register
    it with ``spark.streams.addListener``.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 20):
        self._spark, self._path, self._every = spark, path, every
        self._held: list[tuple] = []
        self._ended: set[str] = set()
        self._changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        self._note(event.name, event.id, event.runId, "started")

    def onQueryProgress(self, event) -> None:
        p = event.progress
        state = p.stateOperators
        self._note(
            p.name, p.id, p.runId, "batch", p.batchId, p.numInputRows, p.batchDuration,
            sum(s.numRowsTotal for s in state), sum(s.numRowsDroppedByWatermark for s in state),
            p.eventTime.get("watermark"),
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._note(None, event.id, event.runId, "ended", failure=event.exception)
        self.flush()
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def _note(
        self, name, query_id, run_id, kind, batch_id=None, input_rows=None, milliseconds=None,
        state_rows=None, late_rows=None, watermark=None, failure=None,
    ) -> None:
        row = (
            datetime.datetime.now(datetime.UTC), name, str(query_id), str(run_id), kind, batch_id, input_rows,
            milliseconds, state_rows, late_rows, watermark, failure,
        )
        with self._changed:
            self._held.append(row)
            full = len(self._held) >= self._every
        if full:
            self.flush()

    def flush(self) -> None:
        with self._changed:
            rows, self._held = self._held, []
        if rows:
            self._spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(self._path)

    def wait_for_end(self, run_ids: list[str], seconds: float = 60) -> None:
        """Listeners hear of an end a little after the query has ended."""
        wanted = {str(run) for run in run_ids}
        with self._changed:
            if not self._changed.wait_for(lambda: wanted <= self._ended, seconds):
                raise TimeoutError(f"no end was noted of {sorted(wanted - self._ended)}")


def progress_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROGRESS).parquet(path)


def run_states(progress: DataFrame) -> DataFrame:
    """(name, query_id, run_id, batches, input_rows, ended, failed, failure) per run.

    Batches are those that were done and had rows. A run whose start is not in the table has
    the name of its batches, or none.
    """
    done = (F.col("kind") == "batch") & (F.col("input_rows") > 0)
    return progress.groupBy("query_id", "run_id").agg(
        F.max("name").alias("name"),
        F.count_distinct(F.when(done, F.col("batch_id"))).alias("batches"),
        F.coalesce(F.sum("input_rows"), F.lit(0)).alias("input_rows"),
        F.bool_or(F.col("kind") == "ended").alias("ended"),
        F.bool_or(F.col("failure").isNotNull()).alias("failed"),
        F.max("failure").alias("failure"),
    )
