"""Replay job: song files to song messages, by year.

    python -m perennial.plans.replay_job --files <folder of csv> --servers <host:port>
"""

from __future__ import annotations

import argparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perennial.operators.cleaning import fill_defaults, prepare_songs, replayable_songs
from perennial.operators.envelope import song_envelope, song_message_key
from perennial.session import build_session, scratch_dir
from perennial.sources import kafka
from perennial.sources.song_files import read_song_files

ROWS_PER_TASK = 500_000


def replay_messages(raw: DataFrame, sent_at: Column | None = None) -> DataFrame:
    """Key, message and year of every song that belongs to a year."""
    songs = fill_defaults(replayable_songs(prepare_songs(raw)))
    moment = F.current_timestamp() if sent_at is None else sent_at
    return kafka.messages(songs, song_message_key(), song_envelope(moment), "year")


def write_replay(messages: DataFrame, path: str) -> None:
    """One folder of messages per year. No shuffle: every task writes the years it holds."""
    messages.write.mode("errorifexists").partitionBy("year").json(path)


def in_year_order(messages: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The messages in ascending order of year, over tasks and within them.

    Every year has tasks of its own, by its number of messages, and a hash of a row's place
    deals them out. So a year with most of the songs is split over as many tasks as any other
    rows, repeated messages are split as well, and the driver gets one row per year, no sample.
    """
    sizes = messages.groupBy("year").agg(F.count(F.lit(1)).alias("n")).orderBy("year").collect()
    years, tasks = [], 0
    for row in sizes:
        pieces = -(-row["n"] // rows_per_task)
        years.append((row["year"], tasks, pieces))
        tasks += pieces
    kind = messages.schema["year"].dataType.simpleString()
    placed = messages.sparkSession.createDataFrame(years, f"_year {kind}, _first int, _pieces int")
    dealt = messages.withColumn("_deal", F.xxhash64(F.monotonically_increasing_id()))
    dealt = dealt.join(F.broadcast(placed), F.col("year").eqNullSafe(F.col("_year")))
    task = F.col("_first") + F.pmod("_deal", "_pieces").cast("int")
    return dealt.repartitionById(max(1, tasks), task).select(messages.columns)


def send_by_year(spark: SparkSession, folder: str, servers: str, topic: str) -> None:
    """Send a replay folder in one job whose tasks start in order of year.

    Tasks that run at the same time may hold neighbouring years; a topic keeps the order in
    which they arrive.
    """
    ordered = in_year_order(spark.read.json(folder))
    kafka.write_messages(ordered.select("key", "value"), servers, topic)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--files", required=True)
    parser.add_argument("--folder", help="where the messages are kept, one folder per year")
    parser.add_argument("--servers", help="Kafka bootstrap servers; left out, nothing is sent")
    parser.add_argument("--topic", default=kafka.SONG_TOPIC)
    options = parser.parse_args()

    spark = build_session("perennial-replay")
    folder = options.folder or scratch_dir(spark, "replay")
    write_replay(replay_messages(read_song_files(spark, options.files)), folder)
    if options.servers:
        send_by_year(spark, folder, options.servers, options.topic)


if __name__ == "__main__":
    main()
