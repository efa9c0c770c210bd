"""Stream messages: building them, reading them, and shaping them for landing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perennial.functions.numbers import truncated_int
from perennial.functions.text import iso_text
from perennial.schemas import EVENT, NUMBER_DEFAULTS, TEXT_COLUMNS
from perennial.sources.kafka import messages

SONG_SOURCE = "song_catalog"


def song_struct() -> Column:
    """The 14 song fields of a message."""
    return F.struct(*[F.col(c) for c in (*TEXT_COLUMNS, *NUMBER_DEFAULTS)])


def message_metadata(sent_at: Column, source: str, *more: Column | str) -> Column:
    """Metadata with its own types, so that numbers and flags are written as such.

    The reader takes it as a map of text to text.
    """
    return F.struct(
        iso_text(sent_at).alias("processing_time"), F.lit(source).alias("source"), *more
    ).alias("metadata")


def song_envelope(sent_at: Column, event_type: str = "historical", source: str = SONG_SOURCE) -> Column:
    """Message for a cleaned song."""
    return F.struct(
        F.lit(event_type).alias("event_type"),
        iso_text(sent_at).alias("timestamp"),
        song_struct().alias("song_data"),
        message_metadata(sent_at, source),
    )


def song_message_key() -> Column:
    return F.concat("artist", F.lit("_"), "title")


def song_messages(songs: DataFrame, sent_at: Column, source: str = SONG_SOURCE) -> DataFrame:
    """Key and message of cleaned songs."""
    return messages(songs, song_message_key(), song_envelope(sent_at, source=source))


def parse_messages(stream: DataFrame, schema: T.StructType = EVENT) -> DataFrame:
    """Message bytes to one struct column. Text that is not JSON keeps its row, all NULL.

    Fields outside ``schema`` are skipped unread: songs need only ``SONG_MESSAGE``.
    """
    return stream.select(F.from_json(F.col("value").cast("string"), schema).alias("message"))


def _song_fields(*names: str) -> list[Column]:
    return [F.col(f"message.song_data.{name}").alias(name) for name in names]


def _metadata(key: str) -> Column:
    return F.col("message.metadata").getItem(key)


def _whole(text: Column) -> Column:
    return truncated_int(text.try_cast("double"))


def flatten_songs(parsed: DataFrame, now: Column | None = None) -> DataFrame:
    """Song messages as flat rows, stamped with the processing time."""
    return parsed.select(
        *_song_fields(
            "title", "artist", "top_genre", "year", "popularity", "energy", "danceability", "valence",
            "acousticness", "bpm", "length",
        ),
        F.col("message.event_type").alias("event_type"),
        F.col("message.timestamp").try_cast("timestamp").alias("source_timestamp"),
        (F.current_timestamp() if now is None else now).alias("processed_at"),
    )


def flatten_events(parsed: DataFrame, now: Column | None = None, correlate: bool = True) -> DataFrame:
    """Live events as flat rows.

    A rollback names its surge in a top-level field and its boost and reason under
    other keys. ``correlate`` reads those too; without it they stay NULL.
    """
    event_id, boost, reason = _metadata("event_id"), _metadata("boost_amount"), _metadata("reason")
    if correlate:
        event_id = F.coalesce(event_id, F.col("message.original_event_id"))
        boost = F.coalesce(boost, _metadata("original_boost"))
        reason = F.coalesce(reason, _metadata("rollback_reason"))
    return parsed.select(
        *_song_fields(
            "title", "artist", "top_genre", "year", "popularity", "energy", "danceability", "valence",
            "acousticness",
        ),
        F.col("message.event_type").alias("event_type"),
        event_id.alias("event_id"),
        _whole(boost).alias("boost_amount"),
        reason.alias("reason"),
        _whole(_metadata("original_popularity")).alias("original_popularity"),
        _metadata("has_timeout").try_cast("boolean").alias("has_timeout"),
        (F.current_timestamp() if now is None else now).alias("processed_at"),
    )


def song_landing(flat: DataFrame) -> DataFrame:
    """Columns of ``song_analytics``."""
    return flat.select(
        "title", "artist", F.col("top_genre").alias("genre"),
        "year", "popularity", "energy", "danceability", "valence", "acousticness",
        "bpm", "length", "processed_at", "event_type", "source_timestamp",
    )


def event_landing(flat: DataFrame) -> DataFrame:
    """Columns of ``real_time_events``: defaults filled, the same values as JSON beside them."""

    def filled(no_text: str) -> list[Column]:
        return [
            F.coalesce("event_id", F.lit(no_text)).alias("event_id"),
            F.coalesce("boost_amount", F.lit(0)).alias("boost_amount"),
            F.coalesce("reason", F.lit(no_text)).alias("reason"),
            F.coalesce("original_popularity", F.lit(0)).alias("original_popularity"),
            F.coalesce("has_timeout", F.lit(False)).alias("has_timeout"),
        ]

    return flat.select(
        "event_type",
        F.col("title").alias("song_title"),
        "artist",
        F.to_json(F.struct(*filled(""))).alias("metadata"),
        F.col("processed_at").alias("created_at"),
        *filled("unknown"),
    )
