"""Kafka topics. Needs Spark's Kafka package on the class path to run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SONG_TOPIC = "historical-songs"
EVENT_TOPIC = "realtime-events"

# Producer settings of the replay.
PRODUCER_SETTINGS = {
    "kafka.compression.type": "gzip",
    "kafka.batch.size": "16384",
    "kafka.linger.ms": "10",
    "kafka.retries": "5",
    "kafka.acks": "all",
}


def source_options(
    servers: str, topic: str, starting_offsets: str, max_offsets_per_trigger: int | None = None
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "false",
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def song_stream(spark: SparkSession, servers: str, topic: str = SONG_TOPIC, **extra) -> DataFrame:
    """History, read from its beginning."""
    options = source_options(servers, topic, "earliest", **extra)
    return spark.readStream.format("kafka").options(**options).load()


def event_stream(spark: SparkSession, servers: str, topic: str = EVENT_TOPIC, **extra) -> DataFrame:
    """Live events, from now on."""
    options = source_options(servers, topic, "latest", **extra)
    return spark.readStream.format("kafka").options(**options).load()


def sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, **PRODUCER_SETTINGS}


def messages(df: DataFrame, key: Column, value: Column, *more: str) -> DataFrame:
    """Key text and JSON text, the two columns a Kafka sink wants, and ``more`` columns.

    ``value`` is a struct; fields that are NULL are left out of the JSON.
    """
    return df.select(key.cast("string").alias("key"), F.to_json(value).alias("value"), *more)


def write_messages(frame: DataFrame, servers: str, topic: str) -> None:
    frame.write.format("kafka").options(**sink_options(servers, topic)).save()


def start_messages(frame: DataFrame, servers: str, topic: str, checkpoint: str):
    return (
        frame.writeStream.format("kafka")
        .options(**sink_options(servers, topic))
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .start()
    )
