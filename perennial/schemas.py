"""Schemas of the song file, the stream messages and the landing tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(kind: T.DataType, *names: str) -> list[T.StructField]:
    return [T.StructField(name, kind, True) for name in names]


# Header of the song file -> column name, in file order.
SONG_FILE_COLUMNS = {
    "Index": "index",
    "Title": "title",
    "Artist": "artist",
    "Top Genre": "top_genre",
    "Year": "year",
    "Beats Per Minute (BPM)": "bpm",
    "Energy": "energy",
    "Danceability": "danceability",
    "Loudness (dB)": "loudness",
    "Liveness": "liveness",
    "Valence": "valence",
    "Length (Duration)": "length",
    "Acousticness": "acousticness",
    "Speechiness": "speechiness",
    "Popularity": "popularity",
}

# Default of every number in a song message.
NUMBER_DEFAULTS = {
    "year": 2000,
    "bpm": 120,
    "energy": 50,
    "danceability": 50,
    "loudness": -10,
    "liveness": 10,
    "valence": 50,
    "length": 180000,
    "acousticness": 20,
    "speechiness": 5,
    "popularity": 50,
}

TEXT_COLUMNS = ("title", "artist", "top_genre")

# Every cell is read as text first; cleaning decides what a bad number means.
RAW_SONG = T.StructType([T.StructField(name, T.StringType(), True) for name in SONG_FILE_COLUMNS])

# The message carries all 14 song fields; the reader keeps the 11 that land.
SONG_STRUCT = T.StructType(
    _fields(T.StringType(), "title", "artist", "top_genre")
    + _fields(
        T.IntegerType(),
        "year", "popularity", "energy", "danceability", "valence", "acousticness", "bpm", "length",
    )
)

EVENT = T.StructType(
    [
        T.StructField("event_type", T.StringType(), True),
        T.StructField("timestamp", T.StringType(), True),
        T.StructField("original_event_id", T.StringType(), True),
        T.StructField("song_data", SONG_STRUCT, True),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType()), True),
    ]
)

# Song messages land without their metadata, so it is not parsed either.
SONG_MESSAGE = T.StructType([f for f in EVENT.fields if f.name in ("event_type", "timestamp", "song_data")])

# A rollback carries its song whole, so a surge is parsed with all fields of the song.
SURGE_MESSAGE = T.StructType(
    [
        T.StructField(
            "song_data",
            T.StructType(
                list(SONG_STRUCT.fields)
                + [T.StructField(name, T.IntegerType(), True) for name in ("loudness", "liveness", "speechiness")]
            ),
            True,
        )
        if field.name == "song_data"
        else field
        for field in EVENT.fields
    ]
)

_SCORE = T.DecimalType(5, 2)

SONG_ANALYTICS = T.StructType(
    _fields(T.StringType(), "title", "artist", "genre")
    + _fields(
        T.IntegerType(),
        "year", "popularity", "energy", "danceability", "valence", "acousticness", "bpm", "length",
    )
    + _fields(T.TimestampType(), "processed_at")
    + _fields(T.StringType(), "event_type")
    + _fields(T.TimestampType(), "source_timestamp")
)

GENRE_TRENDS = T.StructType(
    _fields(T.StringType(), "genre")
    + _fields(_SCORE, "avg_popularity")
    + _fields(T.LongType(), "song_count")
    + _fields(T.TimestampType(), "analysis_window")
    + _fields(_SCORE, "std_popularity")
    + _fields(T.IntegerType(), "max_popularity", "min_popularity")
    + _fields(T.LongType(), "unique_artists")
    + _fields(T.TimestampType(), "created_at")
)

REAL_TIME_EVENTS = T.StructType(
    _fields(T.StringType(), "event_type", "song_title", "artist", "metadata")
    + _fields(T.TimestampType(), "created_at")
    + _fields(T.StringType(), "event_id")
    + _fields(T.IntegerType(), "boost_amount")
    + _fields(T.StringType(), "reason")
    + _fields(T.IntegerType(), "original_popularity")
    + _fields(T.BooleanType(), "has_timeout")
)

TIMELESS_GENRE_METRICS = T.StructType(
    _fields(T.StringType(), "genre")
    + _fields(T.DateType(), "analysis_date")
    + _fields(T.IntegerType(), "analysis_period_years")
    + _fields(
        _SCORE,
        "timeless_score", "consistency_score", "longevity_score", "variance_score", "peak_stability",
    )
    + _fields(T.IntegerType(), "decade_presence", "year_span")
    + _fields(T.LongType(), "total_songs", "total_unique_artists")
    + _fields(T.StringType(), "period_stats", "analysis_metadata")
    + _fields(T.TimestampType(), "created_at")
)

# A relational target also assigns a serial "id"; file tables carry none.
LANDING_TABLES = {
    "song_analytics": SONG_ANALYTICS,
    "genre_trends": GENRE_TRENDS,
    "real_time_events": REAL_TIME_EVENTS,
    "timeless_genre_metrics": TIMELESS_GENRE_METRICS,
}
