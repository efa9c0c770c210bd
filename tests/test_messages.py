import datetime
import json

from pyspark.sql import functions as F

from perennial.operators import envelope, surges
from perennial.params import SurgeParams
from perennial.schemas import NUMBER_DEFAULTS, SONG_MESSAGE

NOW = datetime.datetime(2024, 5, 6, 7, 8, 9, 250000)


def song(spark, popularity=70, **more):
    row = {"title": "Blue", "artist": "Joni", "top_genre": "folk", **dict.fromkeys(NUMBER_DEFAULTS, 5)}
    row |= {"popularity": popularity, "sent": NOW, **more}
    return spark.createDataFrame([row])


def texts(df, value):
    return [json.loads(r[0]) for r in df.select(F.to_json(value)).collect()]


def as_stream_rows(spark, values):
    return spark.createDataFrame([(None if v is None else v.encode(),) for v in values], "value binary")


def test_song_message(spark):
    message = texts(song(spark), envelope.song_envelope(F.col("sent"), source="files"))[0]
    assert list(message) == ["event_type", "timestamp", "song_data", "metadata"]
    assert message["timestamp"] == NOW.isoformat()
    assert len(message["song_data"]) == 14 and message["song_data"]["popularity"] == 70
    assert message["metadata"] == {"processing_time": NOW.isoformat(), "source": "files"}
    assert song(spark).select(envelope.song_message_key()).first()[0] == "Joni_Blue"


def test_round_trip(spark):
    sent = song(spark).select(F.to_json(envelope.song_envelope(F.col("sent"))).alias("value"))
    flat = envelope.song_landing(envelope.flatten_songs(envelope.parse_messages(sent, SONG_MESSAGE)))
    row = flat.first()
    assert (row["title"], row["genre"], row["popularity"], row["event_type"]) == ("Blue", "folk", 70, "historical")
    assert row["source_timestamp"] == NOW and row["processed_at"] is not None
    assert len(flat.columns) == 14


def test_odd_messages_keep_their_rows(spark):
    values = ["not json", None, '{"event_type":"historical","extra":1,"timestamp":"soon"}', "{}"]
    flat = envelope.flatten_songs(envelope.parse_messages(as_stream_rows(spark, values)))
    rows = flat.collect()
    assert len(rows) == 4
    assert [r["event_type"] for r in rows] == [None, None, "historical", None]
    assert all(r["source_timestamp"] is None and r["title"] is None for r in rows)
    events = envelope.event_landing(envelope.flatten_events(envelope.parse_messages(as_stream_rows(spark, values))))
    row = events.first()
    assert (row["event_id"], row["reason"], row["boost_amount"], row["has_timeout"]) == ("unknown", "unknown", 0, False)
    assert json.loads(row["metadata"]) == {
        "event_id": "", "boost_amount": 0, "reason": "", "original_popularity": 0, "has_timeout": False,
    }


def surge(spark, popularity=70, boost=20):
    return song(
        spark, popularity, event_id="e1", boost_amount=boost, reason="radio_play",
        original_popularity=popularity, song_title="Blue", created_at=NOW,
    )


def test_boost_stops_at_the_top(spark):
    for popularity, boost, expected in [(70, 20, 90), (70, 30, 100), (90, 40, 100), (0, 15, 15)]:
        row = surges.surge_boost(surge(spark, popularity, boost)).first()
        assert row["new_popularity"] == expected
        assert row["expire_time"] == NOW + datetime.timedelta(seconds=30)
        assert (row["timeout_duration"], row["has_timeout"]) == (30, True)


def test_surge_message(spark):
    boosted = surges.surge_boost(surge(spark).withColumn("boost_amount", F.lit(20)))
    message = texts(boosted, surges.surge_envelope())[0]
    assert message["song_data"]["popularity"] == 90
    assert message["metadata"]["original_popularity"] == 70
    assert message["metadata"]["new_popularity"] == 90
    assert message["metadata"]["has_timeout"] is True
    assert message["metadata"]["expire_time"] == "2024-05-06T07:08:39.250000"


def test_rollback_message_and_correlation(spark):
    ended = surges.with_rollback(surge(spark))
    message = texts(ended, surges.rollback_envelope())[0]
    assert message["original_event_id"] == "e1" and message["song_data"]["popularity"] == 70
    assert message["metadata"]["rollback_reason"] == "timeout_expired"
    assert message["metadata"]["duration_seconds"] == 30
    parsed = envelope.parse_messages(as_stream_rows(spark, [json.dumps(message)]))
    row = envelope.event_landing(envelope.flatten_events(parsed)).first()
    assert (row["event_id"], row["boost_amount"], row["reason"]) == ("e1", 20, "timeout_expired")
    strict = envelope.event_landing(envelope.flatten_events(parsed, correlate=False)).first()
    assert (strict["event_id"], strict["boost_amount"], strict["reason"]) == ("unknown", 0, "unknown")


def test_rollback_rows(spark):
    given = surge(spark)
    rolled = surges.surge_rollbacks(given, SurgeParams(lifetime_seconds=45))
    row = rolled.first()
    assert (row["message_key"], row["popularity"], row["duration_seconds"]) == ("timeout_e1", 70, 45)
    assert row["created_at"] == NOW + datetime.timedelta(seconds=45)
    both = surges.surges_and_rollbacks(given, rolled)
    assert both.count() == 2 and "original_event_id" in both.columns
    match = surges.matched_rollbacks(given, rolled).first()
    assert match["rolled_back_at"] - match["created_at"] == datetime.timedelta(seconds=45)


def test_new_event_ids_differ(spark):
    rows = surges.new_event_ids(spark.range(50)).collect()
    assert len({r["event_id"] for r in rows}) == 50
