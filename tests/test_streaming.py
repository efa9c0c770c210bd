import datetime
import json
import os
import random
import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from perennial.operators import scoring, trends
from perennial.operators.surges import rollback_messages, surge_rollbacks
from perennial.params import SurgeParams
from perennial.schemas import NUMBER_DEFAULTS, TEXT_COLUMNS
from perennial.plans import surge_job
from perennial.plans.stream_job import STATE_SETTINGS, landed_trends, start_analytics
from perennial.streaming import control, expiry, landing, rescoring

START = datetime.datetime(2024, 1, 1)
SONGS = "title string, artist string, genre string, year int, popularity int, processed_at timestamp"
SURGES = (
    "event_id string, song_title string, artist string, original_popularity int, boost_amount int, created_at timestamp"
)


def write_files(spark, folder, parts, schema):
    """One file per part; names and times in order, so that the stream reads them so."""
    for i, rows in enumerate(parts):
        target = f"{folder}/part{i}"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(target)
        for name in os.listdir(target):
            if name.endswith(".parquet"):
                os.utime(os.path.join(target, name), (1_000_000 + i, 1_000_000 + i))


def read_stream(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/part*")


def run(stream, sink, root, mode="append"):
    control.finish(landing.start_query(stream, sink, f"{root}/checkpoint", output_mode=mode), 120)


def songs(seed, count=400):
    rng = random.Random(seed)
    return [
        (f"t{i}", rng.choice("abc"), rng.choice(["x", "y", None]), rng.choice([1975, 1985, 1995]),
         rng.randrange(1, 100), START + datetime.timedelta(seconds=rng.randrange(1800)))
        for i in range(count)
    ]


def test_trends_over_batches_equal_one_batch_run(spark, root):
    parts = [songs(1), songs(2), songs(3)]
    write_files(spark, f"{root}/in", parts, SONGS)
    found = trends.genre_trends(read_stream(spark, f"{root}/in", SONGS), watermark="1 hour")
    run(found, landing.folder_sink(f"{root}/out", trends.trend_landing), root, "update")
    rows = landing.landed(spark, f"{root}/out")
    keys = ["genre", "analysis_window"]
    latest = landing.latest_versions(rows, keys)
    whole = spark.createDataFrame(sum(parts, []), SONGS)
    plain = trends.trend_landing(trends.genre_trends(whole))
    columns = plain.columns
    expected = sorted(map(tuple, plain.collect()))
    assert sorted(map(tuple, latest.select(columns).collect())) == expected
    assert rows.count() > len(expected)
    landing.compact(spark, f"{root}/out", f"{root}/compact", keys)
    assert sorted(map(tuple, spark.read.parquet(f"{root}/compact").select(columns).collect())) == expected


def test_sums_of_late_batches_equal_one_batch_run(spark, root):
    """Batches in the wrong order, two days apart: no song is lost."""
    later = [(*row[:-1], row[-1] + datetime.timedelta(days=2)) for row in songs(2)]
    parts = [later, songs(1), [*songs(3), ("t", None, "x", 1975, None, START)]]
    write_files(spark, f"{root}/in", parts, SONGS)
    run(read_stream(spark, f"{root}/in", SONGS), landing.folder_sink(f"{root}/out", trends.trend_partials), root)
    merged = trends.trend_landing(trends.merge_trends(landing.landed(spark, f"{root}/out")))
    plain = trends.trend_landing(trends.genre_trends(spark.createDataFrame(sum(parts, []), SONGS)))
    assert sorted(map(str, merged.collect())) == sorted(map(str, plain.collect()))


def test_a_batch_that_runs_again_lands_once(spark, root):
    sink = landing.folder_sink(f"{root}/out")
    for _ in range(2):
        sink(spark.range(5), 0)
    sink(spark.range(2), 1)
    assert landing.landed(spark, f"{root}/out").count() == 7


def test_a_failing_sink_stops_the_query(spark, root):
    write_files(spark, f"{root}/in", [songs(1, 5)], SONGS)

    def broken(_batch, _batch_id):
        raise RuntimeError("no space")

    query = landing.start_query(read_stream(spark, f"{root}/in", SONGS), broken, f"{root}/checkpoint")
    with pytest.raises(Exception, match="no space"):
        query.awaitTermination(60)
    assert control.health([query])[0]["failure"] and control.stopped([query]) == [query]


def surges(times):
    return [(f"e{i}", "t", "a", 50, 20, START + datetime.timedelta(seconds=t)) for i, t in enumerate(times)]


def expired(spark, root, parts, make):
    write_files(spark, f"{root}/in", parts, SURGES)
    run(make(read_stream(spark, f"{root}/in", SURGES)), landing.folder_sink(f"{root}/out"), root)
    return landing.landed(spark, f"{root}/out").drop("batch_id")


@pytest.mark.parametrize("make", [expiry.expire_surges, expiry.expire_by_timer])
def test_surges_expire_when_time_has_passed(spark, root, make):
    parts = [surges([0, 10, 29]), [("late", "t", "a", 50, 20, START + datetime.timedelta(seconds=40))]]
    rows = expired(spark, root, parts, make).collect()
    assert {r["original_event_id"] for r in rows} == {"e0", "e1"}  # 10 + 30 s is exactly due
    assert {r["created_at"] for r in rows} == {START + datetime.timedelta(seconds=s) for s in (30, 40)}
    assert {(r["event_type"], r["original_boost"], r["popularity"]) for r in rows} == {("timeout_rollback", 20, 50)}


def test_expired_surges_are_part_of_the_closed_form(spark, root):
    given = surges(sorted(random.Random(4).sample(range(5000), 60)))
    got = expired(spark, root, [given[:30], given[30:]], expiry.expire_surges)
    closed = surge_rollbacks(spark.createDataFrame(given, SURGES))
    due = closed.where(F.col("created_at") <= F.lit(max(row[-1] for row in given)))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, due.select(got.columns).collect()))


def test_a_repeated_surge_is_rolled_back_once(spark, root):
    parts = [surges([0, 5]), surges([0]), [("end", "t", "a", 50, 20, START + datetime.timedelta(seconds=99))]]
    rows = expired(spark, root, parts, expiry.expire_surges).collect()
    assert sorted(r["original_event_id"] for r in rows) == ["e0", "e1"]


@pytest.mark.parametrize("end", [expiry.ended_surges, expiry.ended_by_timer])
def test_ended_surges_become_messages_with_their_songs(spark, root, end):
    columns = [*TEXT_COLUMNS, *NUMBER_DEFAULTS]
    schema = "event_id string, boost_amount int, created_at timestamp, " + ", ".join(
        f"{c} {'string' if c in TEXT_COLUMNS else 'int'}" for c in columns
    )
    rows = [
        (f"e{i}", None if i else 20, START + datetime.timedelta(seconds=60 * i), "t", "a", "g", *range(11))
        for i in range(3)
    ]
    write_files(spark, f"{root}/in", [rows], schema)
    stream = rollback_messages(end(read_stream(spark, f"{root}/in", schema)))
    run(stream, landing.folder_sink(f"{root}/out"), root)
    got = {r["key"]: json.loads(r["value"]) for r in landing.landed(spark, f"{root}/out").collect()}
    assert set(got) == {"timeout_e0", "timeout_e1"}
    assert got["timeout_e0"]["metadata"]["original_boost"] == 20
    assert "original_boost" not in got["timeout_e1"]["metadata"]
    assert got["timeout_e1"]["song_data"]["popularity"] == 10 and len(got["timeout_e1"]["song_data"]) == 14


def test_late_and_last_surges_end_once(spark, root):
    given = surges([500, 10, 20, 490, 505, 499, 15])
    parts = [given[:1], given[1:3], [given[1], given[3]], given[4:]]
    write_files(spark, f"{root}/in", parts, SURGES)
    run(read_stream(spark, f"{root}/in", SURGES), expiry.expiry_sink(spark, f"{root}/out"), root)
    ended = lambda: sorted(r["event_id"] for r in expiry.landed_ends(spark, f"{root}/out").collect())
    assert ended() == ["e1", "e2", "e6"]
    for _ in range(2):
        expiry.flush_surges(spark, f"{root}/out")
    assert ended() == [f"e{i}" for i in range(7)]


@pytest.mark.parametrize("make", [expiry.expire_surges, expiry.expire_by_timer])
def test_what_a_watermark_passes_over_is_left(spark, root, make):
    given = surges([0, 500, 600, 10, 605])  # the fourth comes late, the last ones stay live
    rollbacks = expired(spark, root, [given[:2], given[2:3], given[3:4], given[4:]], make)
    sent = spark.createDataFrame(given + given[3:4], SURGES)
    left = expiry.surges_left(sent, rollbacks)
    ended = [r["original_event_id"] for r in rollbacks.unionByName(surge_rollbacks(left)).collect()]
    assert "e3" in {r["event_id"] for r in left.collect()}
    assert sorted(ended) == [f"e{i}" for i in range(5)]


def test_wall_clock_needs_no_later_event(spark, root):
    write_files(spark, f"{root}/in", [surges([0, 1])], SURGES)
    ended = expiry.expire_by_timer(
        read_stream(spark, f"{root}/in", SURGES), SurgeParams(lifetime_seconds=1), clock="wall"
    )
    query = landing.start_query(
        ended, landing.folder_sink(f"{root}/out"), f"{root}/checkpoint", every="1 second"
    )
    try:
        for _ in range(60):
            query.awaitTermination(1)
            try:
                if landing.landed(spark, f"{root}/out").count() == 2:
                    break
            except AnalysisException:
                pass  # the first batch is still being written
    finally:
        query.stop()
    assert {r["original_event_id"] for r in landing.landed(spark, f"{root}/out").collect()} == {"e0", "e1"}


def test_expiry_runs_without_python(spark, root):
    write_files(spark, f"{root}/in", [surges([0, 100])], SURGES)
    query = landing.start_query(
        expiry.expire_surges(read_stream(spark, f"{root}/in", SURGES)),
        landing.folder_sink(f"{root}/out"),
        f"{root}/checkpoint",
    )
    control.finish(query, 120)
    plan = query._jsq.explainInternal(True)
    assert "StateStoreSave" in plan and "Pandas" not in plan


def test_scores_follow_the_songs(spark, root):
    parts = [songs(5), songs(6), songs(7)]
    write_files(spark, f"{root}/in", parts, SONGS)
    day = F.lit("2024-02-03").cast("date")
    sink = rescoring.rescoring_sink(spark, f"{root}/partials", f"{root}/scores", as_of=day, snapshot_every=1)
    run(read_stream(spark, f"{root}/in", SONGS), sink, root)
    assert sorted(os.listdir(f"{root}/partials/snapshots")) == ["batch_id=1", "batch_id=2"]
    assert sorted(os.listdir(f"{root}/partials/batches")) == ["batch_id=2"]
    whole = spark.createDataFrame(sum(parts, []), SONGS)
    expected = scoring.score_landing(scoring.timeless_scores(whole, as_of=day)).drop("created_at")
    got = spark.read.parquet(f"{root}/scores").select(expected.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect())) and got.count() == 2


def test_all_queries_together(spark, root):
    def message(title, year):
        return json.dumps(
            {
                "event_type": "historical",
                "timestamp": START.isoformat(),
                "song_data": {"title": title, "artist": "a", "top_genre": "folk", "year": year, "popularity": 60},
            }
        )

    song_rows = [(message(f"t{i}", 1975 + 10 * (i % 2)),) for i in range(60)] + [("not json",)]
    event_rows = [(json.dumps({"event_type": "popularity_surge", "metadata": {"event_id": "e", "boost_amount": 20}}),)]
    write_files(spark, f"{root}/songs", [song_rows], "value string")
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)
    write_files(spark, f"{root}/events", [event_rows], "value string")
    queries = start_analytics(
        spark,
        read_stream(spark, f"{root}/songs", "value string"),
        read_stream(spark, f"{root}/events", "value string"),
        f"{root}/tables",
        once=True,
    )
    for query in queries:
        control.finish(query, 120)
    for key in STATE_SETTINGS:
        spark.conf.unset(key)
    assert all(state["failure"] is None for state in control.health(queries))
    landed = {name: landing.landed(spark, f"{root}/tables/{name}") for name in ("genre_trends", "song_analytics", "real_time_events", "timeless_genre_metrics")}
    assert landed["song_analytics"].count() == 61
    assert landed["genre_trends"].first()["song_count"] == 60
    assert landed["real_time_events"].first()["boost_amount"] == 20
    assert landed["timeless_genre_metrics"].first()["total_songs"] == 60
    control.stop_all(spark)
    assert spark.streams.active == []


def test_copies_can_be_dropped(spark, root):
    def message(title):
        song = {"title": title, "artist": "a", "top_genre": "folk", "year": 1975, "popularity": 60}
        return json.dumps({"event_type": "historical", "timestamp": START.isoformat(), "song_data": song})

    write_files(spark, f"{root}/songs", [[(message("x"),), (message("y"),)], [(message("x"),)]], "value string")
    write_files(spark, f"{root}/events", [[("{}",)]], "value string")
    for name, unique in (("all", False), ("unique", True)):
        queries = start_analytics(
            spark,
            read_stream(spark, f"{root}/songs", "value string"),
            read_stream(spark, f"{root}/events", "value string"),
            f"{root}/{name}",
            once=True,
            unique_songs=unique,
        )
        for query in queries:
            control.finish(query, 120)
    assert landing.landed(spark, f"{root}/all/song_analytics").count() == 3
    assert landing.landed(spark, f"{root}/unique/song_analytics").count() == 2
    assert landed_trends(spark, f"{root}/unique").first()["song_count"] == 2
    assert landed_trends(spark, f"{root}/all").first()["song_count"] == 3


def test_surge_job_takes_surges_back_while_no_event_comes(spark, root):
    song = {"title": "T", "artist": "A", "top_genre": "g", "year": 2000, "popularity": 60}
    detail = {"event_id": "7", "boost_amount": "20", "reason": "r", "original_popularity": "40"}
    sent = {"event_type": "popularity_surge", "timestamp": "2024-01-01T00:00:00", "song_data": song, "metadata": detail}
    values = [json.dumps(sent), "not json", json.dumps(sent | {"metadata": {}})]
    spark.createDataFrame([(v,) for v in values], "value string").write.parquet(f"{root}/in")
    stream = spark.readStream.schema("value string").parquet(f"{root}/in")

    def send(frame):
        return (
            frame.writeStream.format("json")
            .option("checkpointLocation", f"{root}/checkpoint")
            .trigger(processingTime="1 second")
            .start(f"{root}/out")
        )

    query = surge_job.start_rollbacks(stream, send, SurgeParams(lifetime_seconds=2))
    try:
        found, until = [], time.time() + 60
        while not found and time.time() < until:
            time.sleep(1)
            if os.path.isdir(f"{root}/out/_spark_metadata"):
                found = spark.read.schema("key string, value string").json(f"{root}/out").collect()
    finally:
        query.stop()
    assert [row["key"] for row in found] == ["timeout_7"]
    message = json.loads(found[0]["value"])
    assert message["original_event_id"] == "7" and message["song_data"]["popularity"] == 40


def test_an_idle_stream_with_ticks_goes_on(spark, root):
    spark.createDataFrame([("x",)], "genre string").write.parquet(f"{root}/in")
    stream = spark.readStream.schema("genre string").parquet(f"{root}/in")
    batches = []
    query = landing.start_query(
        control.with_ticks(stream),
        lambda batch, number: batches.append((number, batch.where("genre IS NOT NULL").count())),
        f"{root}/checkpoint",
        every="1 second",
    )
    try:
        until = time.time() + 60
        while len(batches) < 3 and time.time() < until:
            time.sleep(0.5)
    finally:
        query.stop()
    assert len(batches) >= 3 and sum(n for _, n in batches) == 1


def test_songs_and_events_land_in_a_database_too(spark, root, monkeypatch):
    sent = []
    monkeypatch.setattr(landing, "append_table", lambda df, url, table: sent.append((url, table, df.count())))
    song = {"event_type": "historical", "timestamp": "2024-01-01T00:00:00", "song_data": {"title": "T", "year": 2000}}
    spark.createDataFrame([(json.dumps(song),)], "value string").write.parquet(f"{root}/in")
    stream = spark.readStream.schema("value string").parquet(f"{root}/in")
    for query in start_analytics(spark, stream, stream, f"{root}/out", once=True, jdbc_url="jdbc:x"):
        control.finish(query, 120)
    assert sorted(sent) == [("jdbc:x", "real_time_events", 1), ("jdbc:x", "song_analytics", 1)]
