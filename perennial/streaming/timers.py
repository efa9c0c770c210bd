"""Surges that end by timers of buckets of ids.

A bucket holds its live surges in a map state, by slots of creation time, each slot as one
value. A batch reads and writes the slots that it touches, not one value per event, and a
slot has one timer, for the first of its surges that ends. The surges themselves stay text
that the state does not look into; Python handles ids and moments only.

The watermark is the clock. Surges are kept apart from it: every surge is sent on as two
rows, one with its moment, which moves the watermark and goes no further, and one without,
which is never late. So a surge that arrives after its end is over at once. Ids of ended
surges are remembered for ``remember_seconds`` behind the watermark, then the slot is dropped.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from perennial.params import SurgeParams

# Moments are kept to the microsecond in the text of a surge.
_MOMENTS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
_NO_SLOT = -1
_STATE = "slots"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class SurgeTimers(StatefulProcessor):
    """The live surges of one bucket, and the ids of those that ended not long ago."""

    def __init__(self, lifetime_ms: int, slot_ms: int, remember_ms: int):
        self.lifetime, self.width, self.remember = lifetime_ms, slot_ms, remember_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # live: [id, due, surge] of each; ended: ids.
        self.slots = handle.getMapState(_STATE, "slot long", "live string, ended string")

    def _slot(self, number: int) -> tuple[list, list]:
        if not self.slots.containsKey((number,)):
            return [], []
        live, ended = self.slots.getValue((number,))
        return json.loads(live), json.loads(ended)

    def _settled(self, number: int, live: list, ended: list, now: int) -> list[str]:
        """End what is due, keep the rest under a timer, and return the ended surges."""
        over = [row for row in live if row[1] is not None and row[1] <= now]
        live = [row for row in live if row[1] is None or row[1] > now]
        ended = ended + [row[0] for row in over if row[0] is not None]
        due = [row[1] for row in live if row[1] is not None]
        forget = (number + 1) * self.width + self.lifetime + self.remember
        if due:
            self.handle.registerTimer(min(due))
        elif number != _NO_SLOT and forget > now:
            self.handle.registerTimer(forget)
        if live or (ended and forget > now):
            self.slots.updateValue((number,), (json.dumps(live), json.dumps(ended)))
        elif self.slots.containsKey((number,)):
            self.slots.removeKey((number,))
        return [row[2] for row in over]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now, arrived = timerValues.getCurrentWatermarkInMs(), {}
        for frame in rows:
            for name, created, surge in zip(frame["event_id"], frame["created_ms"], frame["surge"]):
                if surge is None:  # a moment without a surge
                    continue
                name = None if pd.isna(name) else name
                moment = None if pd.isna(created) else int(created)
                number = _NO_SLOT if moment is None else moment // self.width
                due = None if moment is None else moment + self.lifetime
                arrived.setdefault(number, []).append([name, due, surge])
        over = []
        for number, new in arrived.items():
            live, ended = self._slot(number)
            known = {row[0] for row in live if row[0] is not None} | set(ended)
            for row in new:
                if row[0] is None or row[0] not in known:
                    known.add(row[0])
                    live.append(row)
            over += self._settled(number, live, ended, now)
        yield pd.DataFrame({"surge": pd.Series(over, dtype=object)})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at = expiredTimerInfo.getExpiryTimeInMs() - self.lifetime
        over = []
        # A slot that has surges due, or one to forget.
        for number in {at // self.width, (at - self.remember) // self.width - 1}:
            live, ended = self._slot(number)
            if live or ended:
                over += self._settled(number, live, ended, timerValues.getCurrentWatermarkInMs())
        yield pd.DataFrame({"surge": pd.Series(over, dtype=object)})

    def close(self) -> None:
        pass


def use_rocks(spark: SparkSession) -> None:
    """Map states and timers need this state store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS)


@contextmanager
def state_partitions(spark: SparkSession, buckets: int) -> Iterator[None]:
    """A stream started within has no more partitions of state than there are ``buckets``: each
    costs a state store and a Python worker in every batch, those without a bucket too. It keeps
    the number in its checkpoint."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), buckets)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _surge_of(text: Column, like: DataFrame) -> Column:
    return F.from_json(text, like.schema, _MOMENTS)


def ended_by_timers(
    surges: DataFrame,
    params: SurgeParams = SurgeParams(),
    lateness_seconds: int = 0,
    buckets: int = 64,
    slot_seconds: int = 5,
    remember_seconds: int = 3600,
) -> DataFrame:
    """The surges of a stream whose lifetime is over, with all their columns.

    A surge ends once the watermark, ``lateness_seconds`` behind the newest creation, has
    reached its end; one that arrives later than that ends at once. A surge delivered again
    with the same id and creation ends once, if no later than ``remember_seconds`` after its
    end. Surges without id are all different; those without creation are live until the
    stream is flushed. ``buckets`` is how many groups of ids there are, several per task;
    ``slot_seconds`` is how much time one value of the state covers: a trigger's worth.
    """
    use_rocks(surges.sparkSession)
    plain = [c for c in surges.columns if c not in ("event_id", "created_at")]
    whole = F.to_json(F.struct("event_id", "created_at", *plain), _MOMENTS)
    moment, none = F.col("created_at"), F.lit(None)
    # Up to the next whole millisecond, so that no surge ends before its time.
    created = F.ceil(F.unix_micros("created_at") / 1000).cast("long")
    name = F.col("event_id").cast("string")
    clock = F.struct(moment.alias("moment"), none.cast("string").alias("event_id"), none.cast("long").alias("created_ms"), none.cast("string").alias("surge"))
    payload = F.struct(none.cast("timestamp").alias("moment"), name.alias("event_id"), created.alias("created_ms"), whole.alias("surge"))
    rows = surges.select(F.explode(F.array(clock, payload)).alias("row")).select("row.*")
    watched = rows.withWatermark("moment", f"{lateness_seconds} seconds").where("moment IS NULL")
    watched = watched.withColumn("bucket", F.pmod(F.xxhash64("event_id"), F.lit(buckets)).cast("int"))
    processor = SurgeTimers(params.lifetime_seconds * 1000, slot_seconds * 1000, remember_seconds * 1000)
    ended = watched.groupBy("bucket").transformWithStateInPandas(processor, "surge string", "Append", "EventTime")
    return ended.select(_surge_of(F.col("surge"), surges).alias("row")).select(
        *(F.col(f"row.{c}").alias(c) for c in surges.columns)
    )


def live_by_timers(spark: SparkSession, checkpoint: str, like: DataFrame) -> DataFrame:
    """The surges still live in the state of a stopped stream of ``ended_by_timers``.

    Read from the stream's own checkpoint, so that nothing has to be kept beside it. ``like``
    has the surges' columns. Take them back only once the stream is not to run again.
    """
    state = spark.read.format("statestore").option("stateVarName", _STATE).load(checkpoint)
    held = F.from_json(F.col("user_map_value.live"), "array<array<string>>")
    texts = state.select(F.explode(F.transform(held, lambda row: row[2])).alias("surge"))
    return texts.select(_surge_of(F.col("surge"), like).alias("row")).select(
        *(F.col(f"row.{c}").alias(c) for c in like.columns)
    )
