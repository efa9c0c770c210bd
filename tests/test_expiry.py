"""Surges ended by timers, by bounded tables, and matched with their rollbacks on streams."""

import datetime
import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from perennial.operators.surges import stream_rollback_matches, surge_rollbacks
from perennial.params import SurgeParams
from perennial.plans import surge_job
from perennial.streaming import expiry, landing, timers
from test_streaming import SURGES, START, read_stream, run, surges, write_files


def at(second):
    return START + datetime.timedelta(seconds=second)


def ids(frame, name="event_id"):
    return sorted(r[name] for r in frame.collect())


def timed(spark, root, parts, name="in", schema=SURGES, **options):
    """(ended, live) after a stream of these batches."""
    write_files(spark, f"{root}/{name}", parts, schema)
    stream = read_stream(spark, f"{root}/{name}", schema)
    run(timers.ended_by_timers(stream, **options), landing.folder_sink(f"{root}/{name}-out"), f"{root}/{name}-run")
    live = timers.live_by_timers(spark, f"{root}/{name}-run/checkpoint", stream)
    return landing.landed(spark, f"{root}/{name}-out").drop("batch_id"), live


@pytest.mark.parametrize("slot_seconds", [5, 3600])
def test_timers_end_late_and_due_surges_and_keep_the_rest(spark, root, slot_seconds):
    given = surges([500, 10, 20, 490, 505, 499, 15])
    parts = [given[:1], given[1:3], [given[1], given[3]], given[4:]]
    ended, live = timed(spark, root, parts, buckets=3, slot_seconds=slot_seconds)
    assert ids(ended) == ["e1", "e2", "e6"] and ids(live) == ["e0", "e3", "e4", "e5"]
    rows = {r["event_id"]: tuple(r) for r in ended.unionByName(live).collect()}
    assert rows == {row[0]: row for row in given}


def test_timers_fire_when_the_watermark_gets_there(spark, root):
    given = surges([0, 10, 11, 29, 40, 41])
    ended, live = timed(spark, root, [given[:4], given[4:5], given[5:]], buckets=2, slot_seconds=7)
    assert ids(ended) == ["e0", "e1", "e2"] and ids(live) == ["e3", "e4", "e5"]


def test_timers_know_copies_and_flaws(spark, root):
    copy = ("a", "t", None, None, 20, at(0).replace(microsecond=123_457))
    none = (None, None, None, 1, None, at(1))
    lost = ("c", "t", "a", 1, 1, None)
    end = ("z", "t", "a", 1, 1, at(900))
    parts = [[copy, copy, none, none, lost], [copy, end], [copy], [("y", "t", "a", 1, 1, at(2000))]]
    ended, live = timed(spark, root, parts, buckets=4, remember_seconds=3600)
    assert sorted(map(str, ended.collect())) == sorted(map(str, [
        *spark.createDataFrame([copy, none, none, end], SURGES).collect()
    ]))
    assert ids(live) == ["c", "y"]


def test_forgotten_ids_leave_the_state(spark, root):
    parts = [surges([0]), [("x", "t", "a", 1, 1, at(100))], [("y", "t", "a", 1, 1, at(5000))], [("z", "t", "a", 1, 1, at(5001))]]
    ended, _live = timed(spark, root, parts, buckets=1, slot_seconds=5, remember_seconds=600)
    assert ids(ended) == ["e0", "x"]
    state = spark.read.format("statestore").option("stateVarName", "slots").load(f"{root}/in-run/checkpoint")
    assert [r["k"] for r in state.select("user_map_key.slot", F.col("user_map_key.slot").alias("k")).collect()] == [
        int(at(5000).replace(tzinfo=datetime.timezone.utc).timestamp()) // 5
    ]


def sink_run(spark, root, parts, **options):
    sink = expiry.expiry_sink(spark, f"{root}/out", **options)
    for number, rows in enumerate(parts):
        sink(spark.createDataFrame(rows, SURGES), number)
    return sink


def test_sink_ends_each_surge_once_and_repeats_batches(spark, root):
    draw = random.Random(3)
    given = surges([draw.randrange(4000) for _ in range(60)])
    parts = [given[k : k + 12] + draw.sample(given[: k + 12], 3) for k in range(0, 60, 12)]
    sink = sink_run(spark, root, parts, slice_seconds=120)
    sink(spark.createDataFrame(parts[-1], SURGES), 4)  # again
    for _ in range(2):
        expiry.flush_surges(spark, f"{root}/out", slice_seconds=120)
    ended = expiry.landed_ends(spark, f"{root}/out")
    assert sorted(map(tuple, ended.collect())) == sorted(given)
    # The stream goes on after the flush: nothing ends twice.
    sink(spark.createDataFrame([*given[:5], ("new", "t", "a", 1, 1, at(9000))], SURGES), 5)
    expiry.flush_surges(spark, f"{root}/out", slice_seconds=120)
    assert ids(expiry.landed_ends(spark, f"{root}/out")) == sorted(["new", *(row[0] for row in given)])


def files(folders):
    return sum(name.endswith(".parquet") for f in folders for _d, _s, names in os.walk(f) for name in names)


def test_a_batch_reads_no_more_as_the_stream_gets_older(spark, root):
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        tables = expiry.ExpiryTables(f"{root}/out", 60, 300)
        sink = expiry.expiry_sink(spark, f"{root}/out", slice_seconds=60, remember_seconds=300)
        read = []
        for number in range(36):
            base = 20 * number
            rows = [(f"e{number}-{k}", "t", "a", 1, 1, at(base + 5 * k)) for k in range(3)]
            slices = [int(r[-1].replace(tzinfo=datetime.timezone.utc).timestamp()) // 60 for r in rows]
            folders = tables.read_by(spark, number, sorted({s - d for s in slices for d in (0, 1)}))
            read.append(files(sum(folders.values(), [])))
            sink(spark.createDataFrame(rows, SURGES).coalesce(1), number)
        assert max(read[24:]) <= max(read[6:16])
        held = len(os.listdir(f"{root}/out/ids")), len(os.listdir(f"{root}/out/clock"))
        assert held[0] <= 300 // 60 + 4 and held[1] == 2
        assert not os.path.exists(tables.live(20)) and os.path.exists(tables.live(35))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    expiry.flush_surges(spark, f"{root}/out")
    assert expiry.landed_ends(spark, f"{root}/out").count() == 36 * 3


def test_rows_without_id_move_the_clock(spark, root):
    tick = (None, None, None, None, None, at(31))
    sink_run(spark, root, [surges([0, 2]), [tick]])
    assert ids(expiry.landed_ends(spark, f"{root}/out")) == ["e0"]
    assert ids(expiry.ended_in(spark, f"{root}/out", 1, spark.createDataFrame([], SURGES))) == ["e0"]
    assert expiry.flush_surges(spark, f"{root}/none") is None


def test_streams_are_matched(spark, root):
    given = surges([0, 10, 20, 30, 100])
    closed = [tuple(r) for r in surge_rollbacks(spark.createDataFrame(given, SURGES)).collect()]
    schema = ", ".join(f"{c} {kind}" for c, kind in surge_rollbacks(spark.createDataFrame(given, SURGES)).dtypes)
    back = {r[1]: r for r in closed}
    late = (*back["e2"][:-1], at(20 + 61))
    end = [(None, None, None, None, None, at(4000))]
    write_files(spark, f"{root}/s", [given[:2], given[2:], end], SURGES)
    write_files(spark, f"{root}/r", [[back["e0"]], [back["e4"], late], [(None,) * 9 + (at(4000),)]], schema)
    found = stream_rollback_matches(
        read_stream(spark, f"{root}/s", SURGES), read_stream(spark, f"{root}/r", schema), SurgeParams(), lateness_seconds=120
    )
    run(found, landing.folder_sink(f"{root}/out"), root)
    rows = {r["event_id"]: r["rolled_back_at"] for r in landing.landed(spark, f"{root}/out").collect()}
    assert rows == {"e0": at(30), "e1": None, "e2": None, "e3": None, "e4": at(130)}


def test_surge_job_flushes_when_it_stops(spark, root):
    song = {"title": "T", "artist": "A", "top_genre": "g", "year": 2000, "popularity": 60}
    sent = [
        json.dumps({"event_type": "popularity_surge", "song_data": song, "metadata": {"event_id": str(k), "boost_amount": "20", "original_popularity": "40"}})
        for k in range(3)
    ]
    spark.createDataFrame([(v,) for v in [*sent, "not json"]], "value string").write.parquet(f"{root}/in")
    stream = spark.readStream.schema("value string").parquet(f"{root}/in")
    got = []

    def send(messages):
        got.extend((r["key"], json.loads(r["value"])["song_data"]["popularity"]) for r in messages.collect())

    query = surge_job.start_expiry(stream, send, f"{root}/job", SurgeParams(lifetime_seconds=3600), every="1 second")
    try:
        until = time.time() + 120
        while not query.recentProgress and time.time() < until:
            time.sleep(1)
    finally:
        query.stop()
    assert got == []
    for _ in range(2):
        got.clear()
        surge_job.flush(spark, send, f"{root}/job")
        assert sorted(got) == [(f"timeout_{k}", 40) for k in range(3)]
