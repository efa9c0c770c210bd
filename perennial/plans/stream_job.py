"""Streaming job: land songs and events, keep trends and scores current.

    python -m perennial.plans.stream_job --servers <host:port> --root <shared folder>
"""

from __future__ import annotations

import argparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from perennial.operators import envelope, trends
from perennial.params import ScoringParams
from perennial.schemas import SONG_MESSAGE
from perennial.session import build_session
from perennial.sources import kafka
from perennial.sources.tables import register_views
from perennial.streaming import control, landing
from perennial.streaming.levels import levelled_sink, read_levels
from perennial.streaming.rescoring import rescoring_sink

# Window state that outgrows the memory of the executors is kept on their disks.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )
}

# What runs, and how often.
TRIGGERS = {
    "genre_trends": landing.TREND_TRIGGER,
    "song_analytics": landing.SONG_TRIGGER,
    "real_time_events": landing.EVENT_TRIGGER,
    "timeless_genre_metrics": landing.SCORE_TRIGGER,
}


def start_analytics(
    spark: SparkSession,
    song_messages: DataFrame,
    event_messages: DataFrame,
    root: str,
    params: ScoringParams = ScoringParams(),
    moment: str = "source_timestamp",
    watermark: str = "10 minutes",
    once: bool = False,
    as_of: Column | None = None,
    unique_songs: bool = False,
    jdbc_url: str | None = None,
) -> list[StreamingQuery]:
    """Start the four queries over streams of messages (a ``value`` column).

    Tables and checkpoints share ``root``; starting over means a new root. Trends use
    the time in the message by default; pass ``processed_at`` for arrival time. They land
    as sums per batch, however late a song is, which are merged by levels as the stream
    goes on; ``landed_trends`` reads them. ``once`` reads
    what is there and ends. A replay that is sent twice lands twice unless ``unique_songs``
    drops the copies that arrive within the watermark. With ``jdbc_url`` songs and events
    are appended to the tables of that database as well.
    """
    songs = envelope.flatten_songs(envelope.parse_messages(song_messages, SONG_MESSAGE))
    events = envelope.flatten_events(envelope.parse_messages(event_messages))
    register_views({"historical_songs": songs, "realtime_events": events})
    landed_songs = envelope.song_landing(songs)
    if unique_songs:
        landed_songs = landed_songs.withWatermark("source_timestamp", watermark).dropDuplicatesWithinWatermark(
            ["title", "artist", "genre", "year", "source_timestamp"]
        )

    def sums(batch: DataFrame) -> DataFrame:
        return trends.trend_partials(batch, moment)

    def land(name: str, shape: landing.Shape | None = None) -> landing.BatchSink:
        folder = landing.folder_sink(f"{root}/{name}", shape)
        return landing.each(folder, landing.jdbc_sink(jdbc_url, name, shape)) if jdbc_url else folder

    jobs = {
        "genre_trends": (
            landed_songs,
            levelled_sink(spark, f"{root}/genre_trends", sums, trends.added_partials),
            "append",
        ),
        "song_analytics": (landed_songs, land("song_analytics"), "append"),
        "real_time_events": (events, land("real_time_events", envelope.event_landing), "append"),
        # A new day has scores although no song arrives; empty rows belong to no genre.
        "timeless_genre_metrics": (
            landed_songs if once else control.with_ticks(landed_songs),
            rescoring_sink(
                spark, f"{root}/decade_partials", f"{root}/timeless_genre_metrics", params, as_of=as_of
            ),
            "append",
        ),
    }
    return [
        landing.start_query(
            stream,
            sink,
            f"{root}/checkpoints/{name}",
            every=None if once else TRIGGERS[name],
            output_mode=mode,
            name=name,
        )
        for name, (stream, sink, mode) in jobs.items()
    ]


def landed_trends(spark: SparkSession, root: str) -> DataFrame:
    """The trend table from the sums that ``start_analytics`` landed."""
    return trends.trend_landing(trends.merge_trends(read_levels(spark, f"{root}/genre_trends")))


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--servers", required=True, help="Kafka bootstrap servers")
    parser.add_argument("--root", required=True, help="shared folder of tables and checkpoints")
    parser.add_argument("--song-topic", default=kafka.SONG_TOPIC)
    parser.add_argument("--event-topic", default=kafka.EVENT_TOPIC)
    parser.add_argument("--max-offsets", type=int, help="most messages a batch reads from a topic")
    parser.add_argument("--jdbc-url", help="database whose tables get songs and events as well")
    options = parser.parse_args()
    bound = {"max_offsets_per_trigger": options.max_offsets}

    spark = build_session("perennial-streams", settings=STATE_SETTINGS)
    start_analytics(
        spark,
        kafka.song_stream(spark, options.servers, options.song_topic, **bound),
        kafka.event_stream(spark, options.servers, options.event_topic, **bound),
        options.root,
        jdbc_url=options.jdbc_url,
    )
    try:
        spark.streams.awaitAnyTermination()
    finally:
        control.stop_all(spark)


if __name__ == "__main__":
    main()
