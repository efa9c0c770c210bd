import datetime
import random

import pytest

from perennial.operators import song_events

EVENTS = (
    "event_id string, event_type string, song_title string, artist string, reason string, boost_amount int, "
    "created_at timestamp"
)
SONGS = "title string, artist string, genre string, year int"
START = datetime.datetime(2024, 1, 1)


def event(n, title, artist, reason="radio_play", boost=20, kind="popularity_surge"):
    return (f"e{n:04d}", kind, title, artist, reason, boost, START + datetime.timedelta(seconds=n))


@pytest.fixture
def frames(spark):
    songs = [("Blue", "Joni", "folk", 1971), ("Blue", "Joni", "folk", 1971), ("Blue", "Joni", "folk", 1972),
             (None, None, "noise", 1990), ("So What", "Miles", "hip-hop r&b", 1959)]
    events = [event(i, "So What", "Miles") for i in range(7)]
    events += [event(10, "Blue", "Joni"), event(11, None, None), event(12, "Lost", "Nobody", "", 0), event(13, None, "Miles", "nan", None)]
    return spark.createDataFrame(events, EVENTS), spark.createDataFrame(songs, SONGS)


def test_join_is_null_safe_and_fans_out(frames):
    counts = {r["genre"]: r["event_count"] for r in song_events.event_counts_by_genre(*frames).collect()}
    assert counts == {"folk": 2, "noise": 1, "hip-hop r&b": 7, "Unknown": 2}


def test_lists_by_genre(frames):
    rows = {r["genre"]: r for r in song_events.events_by_genre(*frames).collect()}
    assert rows["folk"]["year_list"] == [1972, 1971]
    assert rows["hip-hop r&b"]["created_at_list"] == sorted(rows["hip-hop r&b"]["created_at_list"], reverse=True)
    assert rows["hip-hop r&b"]["event_count"] == 7
    assert rows["noise"]["song_title_list"] == [None]


def test_lists_are_bounded_and_counts_are_not(frames):
    rows = {r["genre"]: r for r in song_events.events_by_genre(*frames, listed=3).collect()}
    assert {g: r["event_count"] for g, r in rows.items()} == {"folk": 2, "noise": 1, "hip-hop r&b": 7, "Unknown": 2}
    assert [t.second for t in rows["hip-hop r&b"]["created_at_list"]] == [6, 5, 4]


def test_detail_text(frames):
    rows = {r["genre"]: r for r in song_events.event_details(*frames).collect()}
    assert rows["hip-hop r&b"]["detail_text"].splitlines()[:4] == [
        "Hip-Hop R&B", "Total Events: 7", "", "• So What - Miles (1959)",
    ]
    assert rows["hip-hop r&b"]["detail_text"].splitlines()[4] == "  Event: popularity_surge (radio_play) [+20]"
    assert rows["hip-hop r&b"]["detail_text"].endswith("... and 2 more")
    assert rows["Unknown"]["detail_text"].splitlines()[3:] == [
        "• Unknown - Miles (Unknown)", "  Event: popularity_surge",
        "• Lost - Nobody (Unknown)", "  Event: popularity_surge",
    ]


def test_counts_and_newest_equal_the_plain_join(spark):
    """A third of the events name one song; brute force over the whole join agrees."""
    rng = random.Random(3)
    titles, artists = ["hot", "x", "y", None], ["p", "q", None]
    events = [event(i, "hot" if i % 3 == 0 else rng.choice(titles), "p" if i % 3 == 0 else rng.choice(artists)) for i in range(300)]
    songs = [(rng.choice(titles), rng.choice(artists), rng.choice("abc"), rng.randrange(2000, 2004)) for _ in range(60)]
    frames = spark.createDataFrame(events, EVENTS), spark.createDataFrame(songs, SONGS)
    joined = {}
    for e in events:
        matches = {(s[2], s[3]) for s in songs if s[0] == e[2] and s[1] == e[3]} or {("Unknown", None)}
        for genre, year in matches:
            joined.setdefault(genre, []).append((e[6], e[0], year))
    counts = {r["genre"]: r["event_count"] for r in song_events.event_counts_by_genre(*frames).collect()}
    assert counts == {genre: len(rows) for genre, rows in joined.items()}
    newest = {}
    for r in song_events.newest_events_by_genre(*frames).orderBy("genre", "place").collect():
        newest.setdefault(r["genre"], []).append((r["created_at"], r["event_id"], r["year"]))
    key = lambda r: (r[0], r[1], r[2] or 0)
    assert newest == {genre: sorted(rows, key=key, reverse=True)[:5] for genre, rows in joined.items()}


def test_event_type_counts(frames):
    assert [tuple(r) for r in song_events.event_type_counts(frames[0]).collect()] == [("popularity_surge", 11)]


def test_lists_hold_all_of_the_newest_thousand_events(spark):
    songs = spark.createDataFrame([("Blue", "Joni", "folk", 1971), ("So What", "Miles", "jazz", 1959)], SONGS)
    events = [event(i, *(("So What", "Miles") if i % 4 == 0 else ("Blue", "Joni"))) for i in range(1200)]
    rows = song_events.events_by_genre(spark.createDataFrame(events, EVENTS), songs).collect()
    listed = {t for r in rows for t in r["created_at_list"]}
    assert {e[6] for e in events[-1000:]} <= listed
    assert {r["genre"]: len(r["created_at_list"]) for r in rows} == {"folk": 900, "jazz": 300}
    assert {r["genre"]: r["event_count"] for r in rows} == {"folk": 900, "jazz": 300}


def test_only_the_newest_entries_of_large_genres_are_kept(spark):
    """A genre of many entries has a moment to start from, with enough entries since; a genre of
    few, or without moments, has none."""
    from perennial.operators.song_events import _newest_since

    entries = spark.sql(
        "SELECT 'many' AS genre, timestamp_micros(id) AS created_at FROM range(20000) "
        "UNION ALL SELECT 'few', timestamp_micros(id) FROM range(100) UNION ALL SELECT 'none', NULL FROM range(20000)"
    )
    since = {r["_genre"]: r["_since"] for r in _newest_since(entries, 5).collect()}
    assert since["few"] is None and since["none"] is None
    assert 19_700 <= since["many"] <= 19_900
