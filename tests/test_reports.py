import pytest
from pyspark.sql import functions as F

from perennial.operators import leaderboards, reports, scoring, trends
from perennial.plans.report_job import report_tables
from perennial.sources import tables

METRICS = (
    "genre string, analysis_date date, timeless_score decimal(5,2), consistency_score decimal(5,2), "
    "longevity_score decimal(5,2), decade_presence int"
)


@pytest.fixture
def metrics(spark):
    import datetime
    from decimal import Decimal

    old, new = datetime.date(2024, 1, 1), datetime.date(2024, 1, 2)
    rows = [("disco", old, 99, 1, 1, 2)] + [
        (genre, new, score, 50, 40, 3)
        for genre, score in [("rock", "61.5"), ("hip-hop r&b", "70.0"), ("blues", "61.5"), ("pop", "20.0")]
    ]
    rows = [(g, d, *[Decimal(x) for x in figures], n) for g, d, *figures, n in rows]
    return spark.createDataFrame(rows, METRICS)


def test_only_the_newest_snapshot_ranks(metrics):
    ranked = {r["genre"]: r["ranking"] for r in reports.ranked_snapshot(metrics).collect()}
    assert ranked == {"hip-hop r&b": 1, "blues": 2, "rock": 3, "pop": 4}


def test_headline_reports(metrics):
    latest = reports.latest_snapshot(metrics)
    assert tuple(reports.champion(latest).first()) == ("hip-hop r&b", "Hip-Hop R&B", "70.0/100")
    assert [r["label"] for r in reports.picker_options(latest, 2).collect()] == [
        "Hip-Hop R&B (Score: 70.0)",
        "Blues (Score: 61.5)",
    ]
    assert [r["ranking"] for r in reports.top_rankings(latest, 3).collect()] == [1, 2, 3]
    row = reports.summary_table(latest, 1).first()
    assert (row["genre_title"], row["longevity_score_text"], row["decade_presence"]) == ("Hip-Hop R&B", "40.0", 3)
    assert reports.score_components_long(latest, 2).count() == 6


def test_histogram(metrics):
    bins = reports.score_histogram(reports.latest_snapshot(metrics)).orderBy("bin").collect()
    assert [r["genre_count"] for r in bins] == [1] + [0] * 11 + [2, 0, 1]
    assert {r["mean_score"] for r in bins} == {213.0 / 4}
    assert (bins[0]["bin_start"], bins[-1]["bin_end"]) == (20.0, 70.0)


def test_means_keep_the_second_decimal(spark):
    from decimal import Decimal

    df = spark.createDataFrame([("a", Decimal("70.25")), ("b", Decimal("61.55"))], "genre string, timeless_score decimal(5,2)")
    assert reports.score_histogram(df).first()["mean_score"] == 65.9
    assert scoring.score_summary(df).first()["avg_score"] == 65.9


def test_trend_versions_count_once(spark, make_songs, metrics):
    songs = timed_songs(spark).withColumns({"year": F.lit(1990), "title": F.lit("t")})
    landed = trends.trend_landing(trends.genre_trends(songs, exact_artists=True))
    versions = landed.withColumn("batch_id", F.lit(1)).unionByName(landed.withColumn("batch_id", F.lit(2)))
    events = spark.createDataFrame([], "event_id string, event_type string, song_title string, artist string, reason string, boost_amount int, created_at timestamp")
    rolled = [report_tables(songs, t, events, metrics)["genre_trends"].collect() for t in (landed, versions)]
    assert rolled[0] == rolled[1] and rolled[0]


def test_histogram_of_equal_scores_and_of_none(metrics):
    equal = metrics.where("timeless_score = 61.5")
    assert [(r["bin"], r["genre_count"]) for r in reports.score_histogram(equal).collect()] == [(1, 2)]
    assert reports.score_histogram(metrics.limit(0)).collect() == []


def timeline_songs(make_songs):
    rows = [(f"t{i}", f"a{i % 2}", "Rock", 1981 + i % 4, 50 + i) for i in range(6)]
    rows += [("t", "a", "Rock", 1979, 90), ("t", "a", "Rock", 2025, 90), ("t", "a", "rock ", 1980, 10)]
    rows += [("t", "a", "Jazz", 1980, 10)] * 5
    return make_songs(rows)


def test_timeline(make_songs, metrics):
    latest = reports.latest_snapshot(metrics)
    rows = reports.genre_timeline(timeline_songs(make_songs), latest).collect()
    assert [(r["genre"], r["period_label"], r["song_count"]) for r in rows] == [("Rock", "1980-1984", 6)]
    assert (rows[0]["avg_popularity"], rows[0]["unique_artists"]) == (52.5, 2)


def test_timeline_fans_out_over_spellings_among_the_best(spark, make_songs):
    best = spark.createDataFrame([("ROCK", 9.0), ("rock", 8.0)], "genre string, timeless_score double")
    assert reports.genre_timeline(timeline_songs(make_songs), best).first()["song_count"] == 12


def test_timeline_of_genre(make_songs, metrics):
    latest = reports.latest_snapshot(metrics)
    timeline = reports.genre_timeline(timeline_songs(make_songs), latest)
    row = reports.timeline_of_genre(timeline, latest, "ROCK").first()
    assert row["heading"] == "Rock - Timeless Journey (Score: 61.5/100)"
    none = reports.timeline_of_genre(timeline.withColumn("genre", F.lit("soul")), latest, "Soul").first()
    assert none["heading"] == "Soul - Timeless Journey (Score: 0.0/100)"


def test_breakdown_of_one_genre(make_songs):
    songs = make_songs([("t", "a", "Rock", y, p) for y, p in [(1971, 50), (1979, 61), (1980, 10), (1980, 0)]])
    rows = [tuple(r) for r in reports.genre_breakdown(songs, "Rock").collect()]
    assert rows == [(1970, "1970s", 2, 55.5, 1, 1971, 1979), (1980, "1980s", 1, 10.0, 1, 1980, 1980)]
    assert reports.genre_breakdown(songs, "rock").count() == 0
    assert reports.genre_breakdown(songs, "rock", any_case=True).count() == 2


def test_smoke_table(spark):
    rows = [("soul", 40, 1966), ("soul", 60, 1971), ("dub", 50, 1974), (None, 50, None), ("ska", None, 1963), ("ska", 10, 1964)]
    df = spark.createDataFrame(rows, "genre string, popularity int, year int")
    got = [tuple(r) for r in reports.genre_overview(df).collect()]
    assert got == [(None, 50.0, 1, None), ("dub", 50.0, 1, 1974), ("soul", 50.0, 2, 1971), ("ska", 10.0, 2, 1964)]


def test_totals_ignore_missing_names(make_songs, metrics):
    songs = make_songs([("t", "a", "g", 2000, 5), ("t", None, "g", 2001, 5), ("t", "b", None, 2002, 5)])
    assert tuple(reports.catalog_totals(songs, metrics).first()) == (3, 1, 2, 4)
    assert tuple(reports.year_range(songs).first()) == (3, 1, 2000, 2002)
    assert tuple(reports.catalog_totals(songs.limit(0), metrics).first()) == (0, 0, 0, 4)


TIMED = (
    "genre string, artist string, popularity int, processed_at timestamp, energy int, danceability int, "
    "valence int, acousticness int"
)


def timed_songs(spark):
    import datetime

    start = datetime.datetime(2024, 1, 1, 10, 0)
    rows = []
    for n, genre in enumerate(["a", "b", "c", "d", "e", "f"]):
        for i in range(n + 1):
            rows.append((genre, f"x{i % 2}", 10 * n + i, start + datetime.timedelta(minutes=4 * i), n, n, n, n))
    rows += [(None, "x", 100, start, 1, 1, 1, 1)] * 20
    return spark.createDataFrame(rows, TIMED)


def test_window_trends(spark):
    found = trends.genre_trends(timed_songs(spark), exact_artists=True)
    f = found.where("genre = 'f'").orderBy("time_window").collect()
    assert [r["song_count"] for r in f] == [2, 1, 1, 1, 1]
    assert (f[0]["avg_popularity"], f[0]["unique_artists"]) == (50.5, 2)
    assert f[1]["std_popularity"] is None
    assert found.where("genre IS NULL").count() == 0
    landed = trends.trend_landing(found)
    assert dict(landed.dtypes)["avg_popularity"] == "decimal(5,2)"
    assert [r["genre"] for r in trends.trend_rollup(landed, 2).collect()] == ["f", "e"]


def test_reports_of_the_biggest_genres(spark):
    songs = timed_songs(spark)
    assert [r["genre"] for r in trends.top_genres_by_rows(songs).collect()] == ["f", "e", "d", "c", "b"]
    over_time = trends.popularity_over_time(songs)
    assert {r["genre"] for r in over_time.collect()} == {"b", "c", "d", "e", "f"}
    f = over_time.where("genre = 'f'").orderBy("time_bucket").collect()
    assert [r["popularity"] for r in f] == [51.0, 53.5, 55.0]
    features = trends.audio_features(songs)
    assert [(r["genre"], r["energy"]) for r in features.collect()][:2] == [("f", 5.0), ("e", 4.0)]
    assert trends.audio_features_long(features).count() == 20


def test_attribute_sums_and_heatmap(spark):
    rows = [("x", 1990, 10), ("x", 1990, 5), ("y", 1990, 30), ("x", 1995, 7), (None, 1995, 1)]
    songs = spark.createDataFrame(rows, "artist string, year int, popularity int")
    for name in leaderboards.ATTRIBUTES[1:]:
        songs = songs.withColumn(name, F.lit("same"))
    sums = leaderboards.attribute_year_sums(songs).cache()
    artist = sums.where("attribute = 'artist'")
    assert {(r["year"], r["value"], r["total"]) for r in artist.collect()} == {
        (1990, "x", 15), (1990, "y", 30), (1995, "x", 7), (1995, None, 1),
    }
    totals = {(r["attribute"], r["year"]): r["total"] for r in leaderboards.attribute_year_totals(sums).collect()}
    assert totals[("artist", 1990)] == totals[("bpm", 1990)] == 45 and len(totals) == 22
    top = leaderboards.attribute_top(sums, 1, every=5).where("attribute = 'artist'").collect()
    assert {(r["year"], r["value"]) for r in top} == {(1990, "y"), (1995, "x")}
    years = leaderboards.calendar_years(songs)
    matrix = leaderboards.attribute_heatmap(sums, years, n=1)
    assert {tuple(r) for r in matrix.collect()} == {("artist", "y", 30, 0), ("artist", "x", 0, 7)}
    assert leaderboards.heatmap_cells(matrix, years).count() == 4


def test_all_reports_over_landed_tables(spark, make_songs, metrics, root):
    tables.create_tables(spark, root)
    tables.append_rows(timed_songs(spark).withColumn("title", F.lit("t")), root, "song_analytics")
    tables.append_rows(metrics, root, tables.METRICS)
    landed = {name: tables.read_table(spark, root, name) for name in tables.LANDING_TABLES}
    found = report_tables(
        landed["song_analytics"], landed["genre_trends"], landed["real_time_events"], landed[tables.METRICS]
    )
    counts = {name: frame.count() for name, frame in found.items()}
    assert counts["ranking"] == 4 and counts["audio_features"] == 5 and counts["event_details"] == 0
    assert counts["totals"] == 1
