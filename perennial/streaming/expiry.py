"""Surges that expire.

``ended_surges`` needs no Python on the executors: a surge is an aggregate of one
event whose group closes when the watermark, kept one lifetime behind the newest
event, passes its creation. ``ended_by_timer`` keeps a timer per event instead and can
also run on the wall clock, where a surge ends although no further event comes.

``expiry_sink`` keeps the live surges in a table per batch instead of a state store: a
surge that arrives after its end is over at once, and ``flush_surges`` ends those that are
left when a stream stops, so every surge is rolled back once. What a batch reads does not
grow with the age of the stream. ``streaming/timers.py`` does the same with timers in a
state store.

All return the ended surges with all their columns, ready for ``surge_rollbacks`` or
``rollback_messages``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from perennial.operators.surges import surge_rollbacks
from perennial.params import SurgeParams
from perennial.sources.tables import drop_folder, folder_exists
from perennial.streaming.landing import BatchSink


def ended_surges(
    surges: DataFrame, params: SurgeParams = SurgeParams(), lateness_seconds: int = 0
) -> DataFrame:
    """Surges whose lifetime is over in event time.

    A surge delivered twice ends once. ``lateness_seconds`` holds every end back by that
    much to wait for late events.
    """
    delay = f"{params.lifetime_seconds + lateness_seconds} seconds"
    keys = ["event_id", "created_at"]
    carried = [F.first(name).alias(name) for name in surges.columns if name not in keys]
    ended = surges.withWatermark("created_at", delay).groupBy(*keys).agg(*carried)
    return ended.select(*surges.columns)


def ended_by_timer(
    surges: DataFrame,
    params: SurgeParams = SurgeParams(),
    clock: str = "event",
    lateness_seconds: int = 0,
) -> DataFrame:
    """Surges ended by one timer per event id, on the ``event`` or the ``wall`` clock.

    A group is a single event, so no group grows. A second surge of the same id
    restarts its timer.
    """
    fields = [field for field in surges.schema.fields if field.name != "event_id"]
    names = [field.name for field in fields]
    whole = {field.name for field in fields if isinstance(field.dataType, T.IntegralType)}
    moment = names.index("created_at")
    lifetime_ms = params.lifetime_seconds * 1000
    by_event = clock == "event"

    def values(frame: pd.DataFrame, name: str) -> list:
        """A column of numbers with a gap arrives as float."""
        cells = (None if pd.isna(cell) else cell for cell in frame[name].astype(object))
        return [int(c) if c is not None and name in whole else c for c in cells]

    def step(
        key: tuple[str], frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            ended = {"event_id": key[0], **dict(zip(names, state.get))}
            state.remove()
            yield pd.DataFrame([ended], dtype=object)
            return
        newest = state.get if state.exists else None
        for frame in frames:
            for row in zip(*(values(frame, name) for name in names)):
                if newest is None or row[moment] > newest[moment]:
                    newest = row
        state.update(newest)
        if by_event:
            # A timer fires once the watermark is past it; a surge ends when it is reached.
            due = -(-pd.Timestamp(newest[moment]).value // 1_000_000) + lifetime_ms
            state.setTimeoutTimestamp(max(due - 1, state.getCurrentWatermarkMs() + 1))
        else:
            state.setTimeoutDuration(lifetime_ms)

    watched = surges.select("event_id", *names)
    if by_event:
        watched = watched.withWatermark("created_at", f"{lateness_seconds} seconds")
    timeout = GroupStateTimeout.EventTimeTimeout if by_event else GroupStateTimeout.ProcessingTimeTimeout
    ended = watched.groupBy("event_id").applyInPandasWithState(
        step, watched.schema, T.StructType(fields), "append", timeout
    )
    return ended.select(*surges.columns)


def expire_surges(
    surges: DataFrame, params: SurgeParams = SurgeParams(), lateness_seconds: int = 0
) -> DataFrame:
    """Rollback rows in event time."""
    return surge_rollbacks(ended_surges(surges, params, lateness_seconds), params)


def expire_by_timer(
    surges: DataFrame,
    params: SurgeParams = SurgeParams(),
    clock: str = "event",
    lateness_seconds: int = 0,
) -> DataFrame:
    """Rollback rows from timers."""
    return surge_rollbacks(ended_by_timer(surges, params, clock, lateness_seconds), params)


def surges_left(sent: DataFrame, rollbacks: DataFrame) -> DataFrame:
    """The surges of ``sent`` that no row of ``rollbacks`` names, each once.

    For a stream that has stopped: the watermark of ``expire_surges`` and
    ``expire_by_timer`` passes over surges that come late, and the last ones were still
    live. Rolled back with ``surge_rollbacks``, they complete the stream's rollbacks.
    """
    done = rollbacks.select(F.col("original_event_id").alias("event_id"))
    return sent.dropDuplicates(["event_id"]).join(done, "event_id", "left_anti").select(sent.columns)


def _landed(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:  # nothing landed yet
        return None


def _micros(moment: str) -> Column:
    return F.unix_micros(F.col(moment).cast("timestamp"))


@dataclass(frozen=True)
class ExpiryTables:
    """Folders of ``expiry_sink`` below ``path``. All that a batch reads is named here.

    ``rows/batch_id=n/over=true``: surges that batch n ended, the sink's output.
    ``rows/batch_id=n/over=false``: surges live after batch n; kept for the next two batches.
    ``clock/batch_id=n``: the newest creation up to batch n, in microseconds.
    ``ids/slice=s/batch_id=n``: ids of ended surges that were created in slice s of time.
    ``flushed/batch_id=n``: surges ended by ``flush_surges`` after batch n.
    """

    path: str
    slice_seconds: int = 60
    remember_seconds: int = 86_400

    @property
    def width(self) -> int:
        return self.slice_seconds * 1_000_000

    def rows(self, batch_id: int) -> str:
        return f"{self.path}/rows/batch_id={batch_id}"

    def live(self, batch_id: int) -> str:
        return f"{self.rows(batch_id)}/over=false"

    def clock(self, batch_id: int) -> str:
        return f"{self.path}/clock/batch_id={batch_id}"

    def ids(self, slice_: int) -> str:
        return f"{self.path}/ids/slice={slice_}"

    def horizon(self, clock: int | None) -> int | None:
        """The first slice that is still remembered."""
        return None if clock is None else (clock - self.remember_seconds * 1_000_000) // self.width

    def read_by(self, spark: SparkSession, batch_id: int, slices: list[int]) -> dict[str, list[str]]:
        """The folders that a batch reads which holds surges of these slices."""
        named = {"clock": [self.clock(batch_id - 1)], "live": [self.live(batch_id - 1)], "ids": [self.ids(s) for s in slices]}
        return {what: [f for f in folders if folder_exists(spark, f)] for what, folders in named.items()}


def _keep_ids(ended: DataFrame, tables: ExpiryTables, batch_id: int) -> None:
    """Note the ids of ended surges by the slice of their creation, replacing this batch's own."""
    created = F.floor(_micros("created_at") / tables.width).cast("long")
    noted = ended.where("created_at IS NOT NULL").select(
        "event_id", created.alias("slice"), F.lit(batch_id).cast("long").alias("batch_id")
    )
    noted.repartition("slice").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "slice", "batch_id"
    ).parquet(f"{tables.path}/ids")


def expiry_sink(
    spark: SparkSession,
    path: str,
    params: SurgeParams = SurgeParams(),
    slice_seconds: int = 60,
    remember_seconds: int = 86_400,
) -> BatchSink:
    """Land the surges of each batch, and those still live before it, as over or live.

    The clock is the newest creation seen so far; a row without ``event_id`` moves it and is
    no surge. A batch reads the live surges of the one before it and the ended ids of the
    slices of time that its own surges were created in, whatever the age of the stream; ids
    more than ``remember_seconds`` behind the clock are deleted. A surge delivered again
    counts once while it is live or remembered. A late surge ends at once. A batch that runs
    again replaces its own rows only. Surges without creation are live until the flush.
    """
    tables = ExpiryTables(path, slice_seconds, remember_seconds)

    def write(batch: DataFrame, batch_id: int) -> None:
        slice_of = F.floor(_micros("created_at") / tables.width).cast("long")
        facts = batch.agg(
            F.max(_micros("created_at")).alias("clock"),
            F.collect_set(F.when(F.col("event_id").isNotNull(), slice_of)).alias("slices"),
        ).first()
        earlier = None
        if batch_id and folder_exists(spark, tables.clock(batch_id - 1)):
            earlier = spark.read.schema("clock long").parquet(tables.clock(batch_id - 1)).first()["clock"]
        now = max((c for c in (facts["clock"], earlier) if c is not None), default=None)
        slices = set(facts["slices"])
        if earlier is not None:  # of the surges that are live
            slices |= set(range((earlier - params.lifetime_seconds * 1_000_000) // tables.width, earlier // tables.width + 1))
        folders = tables.read_by(spark, batch_id, sorted(slices))

        rows = batch.where(F.col("event_id").isNotNull())
        if folders["live"]:
            rows = rows.unionByName(spark.read.schema(batch.schema).parquet(*folders["live"]))
        if folders["ids"]:
            ended = spark.read.schema("event_id string, slice long, batch_id long").option("basePath", f"{path}/ids")
            ended = ended.parquet(*folders["ids"]).where(F.col("batch_id") < batch_id).select("event_id")
            rows = rows.join(ended, "event_id", "left_anti").select(batch.columns)
        due = _micros("created_at") + params.lifetime_seconds * 1_000_000
        over = F.coalesce(due <= F.lit(now).cast("long"), F.lit(False))
        marked = rows.dropDuplicates(["event_id"]).withColumn("over", over)
        marked.write.mode("overwrite").partitionBy("over").parquet(tables.rows(batch_id))
        _keep_ids(spark.read.schema(marked.schema).parquet(tables.rows(batch_id)).where("over"), tables, batch_id)
        spark.createDataFrame([(now,)], "clock long").write.mode("overwrite").parquet(tables.clock(batch_id))

        if batch_id > 1:
            drop_folder(spark, tables.live(batch_id - 2))
            drop_folder(spark, tables.clock(batch_id - 2))
        if earlier is not None:
            for gone in range(tables.horizon(earlier), min(tables.horizon(now), earlier // tables.width + 1)):
                drop_folder(spark, tables.ids(gone))

    return write


def flush_surges(spark: SparkSession, path: str, slice_seconds: int = 60) -> DataFrame | None:
    """End the surges that were live after the last batch and return them, or nothing if no
    batch has landed. For a stream that has stopped; it may run again afterwards, and a
    flush that is repeated ends no surge twice."""
    clocks = _landed(spark, f"{path}/clock")
    last = clocks.agg(F.max("batch_id").alias("last")).first()["last"] if clocks is not None else None
    if last is None:
        return None
    tables = ExpiryTables(path, slice_seconds)
    target = f"{path}/flushed/batch_id={last}"
    if folder_exists(spark, tables.live(last)):
        left = spark.read.parquet(tables.live(last))
        left.write.mode("overwrite").parquet(target)
        # Before any batch, so that one that runs again knows them.
        _keep_ids(spark.read.schema(left.schema).parquet(target), tables, -1)
        drop_folder(spark, tables.live(last))
    return spark.read.parquet(target) if folder_exists(spark, target) else None


def landed_ends(spark: SparkSession, path: str) -> DataFrame:
    """The ended surges that ``expiry_sink`` and ``flush_surges`` landed."""
    ended = spark.read.parquet(f"{path}/rows").where(F.col("over").cast("boolean")).drop("batch_id", "over")
    flushed = _landed(spark, f"{path}/flushed")
    return ended if flushed is None else ended.unionByName(flushed.drop("batch_id"))


def ended_in(spark: SparkSession, path: str, batch_id: int, like: DataFrame) -> DataFrame:
    """The surges that one batch ended, with the columns of ``like``."""
    folder = f"{ExpiryTables(path).rows(batch_id)}/over=true"
    found = spark.read.schema(like.schema)
    return found.parquet(folder) if folder_exists(spark, folder) else spark.createDataFrame([], like.schema)
