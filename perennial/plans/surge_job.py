"""Surge job: take back every surge of the event topic when its lifetime is over, and those
that are still live when the job ends.

    python -m perennial.plans.surge_job --servers <host:port> --root <shared folder>
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from perennial.operators import envelope, surges
from perennial.params import SurgeParams
from perennial.plans.stream_job import STATE_SETTINGS
from perennial.schemas import SURGE_MESSAGE
from perennial.session import build_session
from perennial.sources import kafka
from perennial.streaming import control, expiry, landing


def rollbacks(event_messages: DataFrame, params: SurgeParams = SurgeParams()) -> DataFrame:
    """Messages that take surges back, one lifetime after they arrived.

    Surges count from their arrival, so none is late, and ticks move the watermark on
    while no event comes. Live surges are state in the checkpoint: after a stop they end
    when the job runs again.
    """
    arrived = surges.surges_from_messages(envelope.parse_messages(event_messages, SURGE_MESSAGE))
    ended = expiry.ended_surges(control.with_ticks(arrived, "created_at"), params)
    # Not by the id: a filter on a group's key would take the ticks out before the watermark.
    return surges.rollback_messages(ended.where(F.col("event_type") == surges.SURGE), params)


def start_rollbacks(
    event_messages: DataFrame,
    send: Callable[[DataFrame], StreamingQuery],
    params: SurgeParams = SurgeParams(),
) -> StreamingQuery:
    return send(rollbacks(event_messages, params))


def start_expiry(
    event_messages: DataFrame,
    send: Callable[[DataFrame], None],
    root: str,
    params: SurgeParams = SurgeParams(),
    every: str = landing.EVENT_TRIGGER,
) -> StreamingQuery:
    """Take surges back from tables of live and ended surges below ``root``, batch by batch.

    ``send`` sends the messages of a batch. A batch that is run again after a failure sends
    its messages again. Ticks move the clock while no event comes.
    """
    spark = event_messages.sparkSession
    arrived = surges.surges_from_messages(envelope.parse_messages(event_messages, SURGE_MESSAGE))
    land = expiry.expiry_sink(spark, f"{root}/surges", params)

    def write(batch: DataFrame, batch_id: int) -> None:
        land(batch, batch_id)
        ended = expiry.ended_in(spark, f"{root}/surges", batch_id, batch)
        send(surges.rollback_messages(ended, params))

    ticking = control.with_ticks(arrived, "created_at")
    return landing.start_query(ticking, write, f"{root}/checkpoints/expiry", every=every)


def flush(
    spark: SparkSession, send: Callable[[DataFrame], None], root: str, params: SurgeParams = SurgeParams()
) -> None:
    """Take back every surge that is still live. For a job whose query has stopped."""
    left = expiry.flush_surges(spark, f"{root}/surges")
    if left is not None:
        send(surges.rollback_messages(left, params))


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--servers", required=True, help="Kafka bootstrap servers")
    parser.add_argument("--root", required=True, help="shared folder of the checkpoint")
    parser.add_argument("--event-topic", default=kafka.EVENT_TOPIC)
    parser.add_argument("--max-offsets", type=int, help="most messages a batch reads")
    options = parser.parse_args()

    spark = build_session("perennial-surges", settings=STATE_SETTINGS)
    events = kafka.event_stream(
        spark, options.servers, options.event_topic, max_offsets_per_trigger=options.max_offsets
    )

    def send(messages: DataFrame) -> None:
        kafka.write_messages(messages, options.servers, options.event_topic)

    query = start_expiry(events, send, options.root)
    try:
        query.awaitTermination()
    finally:
        control.stop_all(spark)
        flush(spark, send, options.root)


if __name__ == "__main__":
    main()
