"""Popularity surges and their rollback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perennial.functions.text import iso_text
from perennial.operators.envelope import SONG_SOURCE, message_metadata, song_struct
from perennial.params import SurgeParams
from perennial.sources.kafka import messages

SURGE = "popularity_surge"
ROLLBACK = "timeout_rollback"
ROLLBACK_SOURCE = "timeout_system"
ROLLBACK_REASON = "timeout_expired"


def _expiry(params: SurgeParams) -> Column:
    return F.col("created_at") + F.make_dt_interval(secs=F.lit(params.lifetime_seconds))


def surge_boost(surges: DataFrame, params: SurgeParams = SurgeParams()) -> DataFrame:
    """Add the boosted popularity and the expiry to surges.

    Needs ``original_popularity``, ``boost_amount`` and ``created_at``.
    """
    boosted = F.least(F.lit(params.max_popularity), F.col("original_popularity") + F.col("boost_amount"))
    return surges.withColumns(
        {
            "new_popularity": boosted,
            "expire_time": _expiry(params),
            "timeout_duration": F.lit(params.lifetime_seconds),
            "has_timeout": F.lit(True),
        }
    )


def new_event_ids(songs: DataFrame) -> DataFrame:
    """Give every row an identifier of its own. Each evaluation draws new ones, so
    write the result down before using it twice."""
    return songs.withColumn("event_id", F.uuid())


def surge_envelope(source: str = SONG_SOURCE) -> Column:
    """Message of a boosted surge that carries its song's 14 fields."""
    song = song_struct().withField("popularity", F.col("new_popularity"))
    return F.struct(
        F.lit(SURGE).alias("event_type"),
        iso_text(F.col("created_at")).alias("timestamp"),
        song.alias("song_data"),
        message_metadata(
            F.col("created_at"),
            source,
            "event_id",
            "boost_amount",
            "reason",
            "original_popularity",
            "new_popularity",
            iso_text(F.col("expire_time")).alias("expire_time"),
            "timeout_duration",
            "has_timeout",
        ),
    )


def with_rollback(surges: DataFrame, params: SurgeParams = SurgeParams()) -> DataFrame:
    """Turn surges into their rollbacks, due when they expire; the song's fields stay
    at their original values."""
    return surges.withColumns(
        {
            "event_type": F.lit(ROLLBACK),
            "original_event_id": F.col("event_id"),
            "message_key": F.concat(F.lit("timeout_"), "event_id"),
            "original_boost": F.col("boost_amount"),
            "rollback_reason": F.lit(ROLLBACK_REASON),
            "duration_seconds": F.lit(params.lifetime_seconds),
            "created_at": _expiry(params),
        }
    )


def surge_rollbacks(surges: DataFrame, params: SurgeParams = SurgeParams()) -> DataFrame:
    """One rollback row per surge.

    This is the closed form: every surge is rolled back, the ones still live at the
    end of the input included.
    """
    return with_rollback(surges, params).select(
        "event_type",
        "original_event_id",
        "message_key",
        "song_title",
        "artist",
        F.col("original_popularity").alias("popularity"),
        "original_boost",
        "rollback_reason",
        "duration_seconds",
        "created_at",
    )


def rollback_envelope(source: str = ROLLBACK_SOURCE) -> Column:
    """Message of a rollback row that carries its song's 14 original fields."""
    return F.struct(
        F.lit(ROLLBACK).alias("event_type"),
        iso_text(F.col("created_at")).alias("timestamp"),
        "original_event_id",
        song_struct().alias("song_data"),
        message_metadata(
            F.col("created_at"), source, "original_boost", "rollback_reason", "duration_seconds"
        ),
    )


def surge_messages(surges: DataFrame, params: SurgeParams = SurgeParams()) -> DataFrame:
    """Key and message of new surges; needs the song's 14 fields at their original values."""
    return messages(surge_boost(surges, params), F.col("event_id"), surge_envelope())


def surges_from_messages(parsed: DataFrame, arrived: Column | None = None) -> DataFrame:
    """Surges of parsed messages with their song at its original values, created when they
    ``arrived`` (now). Other messages, and surges without an id, are left out."""
    detail = F.col("message.metadata")
    original = detail.getItem("original_popularity").try_cast("int")
    song = [
        original.alias(name) if name == "popularity" else F.col(f"message.song_data.{name}").alias(name)
        for name in parsed.schema["message"].dataType["song_data"].dataType.names
    ]
    return parsed.where(
        (F.col("message.event_type") == SURGE) & detail.getItem("event_id").isNotNull()
    ).select(
        detail.getItem("event_id").alias("event_id"),
        "message.event_type",
        detail.getItem("reason").alias("reason"),
        detail.getItem("boost_amount").try_cast("int").alias("boost_amount"),
        original.alias("original_popularity"),
        (F.current_timestamp() if arrived is None else arrived).alias("created_at"),
        *song,
    )


def rollback_messages(ended: DataFrame, params: SurgeParams = SurgeParams()) -> DataFrame:
    """Key and message that take ended surges back."""
    return messages(with_rollback(ended, params), F.col("message_key"), rollback_envelope())


def surges_and_rollbacks(surges: DataFrame, rollbacks: DataFrame) -> DataFrame:
    """Both kinds of event in one table, as they share one topic."""
    return surges.unionByName(rollbacks, allowMissingColumns=True)


def matched_rollbacks(surges: DataFrame, rollbacks: DataFrame) -> DataFrame:
    """Surges beside the rollback that names them; both sides are keyed by event."""
    ended = rollbacks.select(
        F.col("original_event_id").alias("event_id"),
        F.col("created_at").alias("rolled_back_at"),
        "original_boost",
    )
    return surges.join(ended, "event_id")


def stream_rollback_matches(
    surges: DataFrame,
    rollbacks: DataFrame,
    params: SurgeParams = SurgeParams(),
    slack_seconds: int = 30,
    lateness_seconds: int = 60,
) -> DataFrame:
    """Two streams: every surge beside the rollback that names it, or alone if none does.

    A rollback belongs to its surge if it is created within the lifetime and ``slack_seconds``
    of it, so each side is held as state only that long, and ``lateness_seconds`` for late
    rows; later rows than that are not seen. A surge is known to be alone, and comes out with
    NULLs, once both streams are past that time: a stream that may fall silent needs
    ``control.with_ticks`` to move on. Further columns of surges are kept.
    """
    delay, longest = f"{lateness_seconds} seconds", params.lifetime_seconds + slack_seconds
    # A key is never NULL: the optimizer would take a tick, which has no id, out of the stream
    # before the watermark sees it.
    key = F.coalesce(F.concat(F.lit("="), "original_event_id"), F.lit("-"))
    ended = rollbacks.select(
        key.alias("_ended_key"), F.col("created_at").alias("rolled_back_at"), "original_boost"
    ).withWatermark("rolled_back_at", delay)
    given = surges.withWatermark("created_at", delay)
    until = F.expr(f"created_at + INTERVAL {longest} SECONDS")  # a literal, as the state's bound
    same = (
        (F.concat(F.lit("="), "event_id") == F.col("_ended_key"))
        & (F.col("rolled_back_at") >= F.col("created_at"))
        & (F.col("rolled_back_at") <= until)
    )
    return given.join(ended, same, "left_outer").drop("_ended_key")
