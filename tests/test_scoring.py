import random

import pytest
from pyspark.sql import functions as F

from perennial.operators import decades, scoring
from perennial.params import ScoringParams
from perennial.plans.score_job import champion_breakdown, run_scoring
from perennial.streaming.rescoring import scores_from_partials


def genre_rows(genre, plan, artist="artist"):
    """plan: (year, popularity, count)."""
    return [
        (f"t{i}", f"{artist}{i % 3}", genre, year, popularity)
        for year, popularity, count in plan
        for i in range(count)
    ]


GOLDEN = genre_rows("g", [(1975, 60, 25), (1985, 64, 25)])


def scored(df, **options):
    return {r["genre"]: r for r in scoring.timeless_scores(df, **options).collect()}


def test_golden_example(make_songs):
    row = scored(make_songs(GOLDEN))["g"]
    assert row["timeless_score"] == 43.9
    assert row["consistency_score"] == 86.3
    assert row["longevity_score"] == 27.1
    assert row["stability_score"] == 87.1
    assert row["decade_presence_score"] == 7.7
    assert (row["popularity_penalty"], row["recency_penalty"]) == (0, 12)
    assert (row["avg_popularity"], row["popularity_tier"]) == (62.0, "medium")
    assert (row["decade_presence"], row["time_span_decades"], row["total_songs"]) == (2, 2.0, 50)


def test_golden_summary(make_songs):
    row = decades.genre_summary(decades.decade_stats(make_songs(GOLDEN)), with_detail=True).first()
    assert (row["overall_avg_popularity"], row["decade_popularity_variance"]) == (62.0, 2.83)
    assert [tuple(d) for d in row["decade_data"]] == [(1970, 60.0, 25), (1980, 64.0, 25)]
    assert row["total_artists"] == 6


def test_equal_averages(make_songs):
    row = scored(make_songs(genre_rows("g", [(1975, 60, 25), (1985, 60, 25)])))["g"]
    assert (row["consistency_score"], row["stability_score"]) == (85.0, 70.0)


@pytest.mark.parametrize(
    ("plan", "qualifies"),
    [
        ([(1975, 60, 9), (1985, 60, 60)], False),
        ([(1975, 60, 10), (1985, 60, 60)], True),
        ([(1975, 60, 24), (1985, 60, 25)], False),
        ([(1975, 60, 60)], False),
        ([(1975, 1, 30), (1985, 100, 30)], False),
        ([(1975, 0, 30), (1985, 60, 30), (1995, 60, 30)], True),
        ([(1899, 60, 30), (1985, 60, 50)], False),
        ([(1900, 60, 30), (1985, 60, 50)], True),
        ([(2030, 60, 30), (1985, 60, 50)], True),
        ([(2031, 60, 30), (1985, 60, 50)], False),
    ],
)
def test_thresholds(make_songs, plan, qualifies):
    assert bool(scored(make_songs(genre_rows("g", plan)))) is qualifies


def test_profiles_differ_on_high_popularity_and_missing_titles(make_songs):
    rows = GOLDEN + [(None, "a", "g", 1975, 60), ("t", None, "g", 1975, 60), ("t", "a", "g", 1975, 101)]
    assert scored(make_songs(rows))["g"]["total_songs"] == 53
    strict = scored(make_songs(rows), profile="strict", normalize_genre=False)["g"]
    assert strict["total_songs"] == 50


def test_missing_artists_do_not_count_as_artists(make_songs):
    rows = [(t, None if a == "artist0" else a, g, y, p) for t, a, g, y, p in GOLDEN]
    stats = decades.decade_stats(make_songs(rows)).collect()
    assert {r["unique_artists"] for r in stats} == {2}


@pytest.mark.parametrize(
    ("mean", "penalty", "tier"),
    [(29, 15, "low"), (30, 8, "low"), (44, 8, "low"), (45, 3, "medium"), (59, 3, "medium"),
     (60, 0, "medium"), (69, 0, "medium"), (70, 0, "high")],
)
def test_popularity_steps(make_songs, mean, penalty, tier):
    row = scored(make_songs(genre_rows("g", [(1975, mean, 30), (1985, mean, 30)])))["g"]
    assert (row["popularity_penalty"], row["popularity_tier"]) == (penalty, tier)


@pytest.mark.parametrize(("last", "penalty"), [(2000, 12), (2010, 6), (2020, 0)])
def test_recency_steps(make_songs, last, penalty):
    row = scored(make_songs(genre_rows("g", [(1975, 60, 30), (last, 60, 30)])))["g"]
    assert row["recency_penalty"] == penalty


def test_genre_spellings_meet_only_if_normalized(make_songs):
    rows = genre_rows("Rock", [(1975, 60, 25)]) + genre_rows(" rock ", [(1985, 64, 25)])
    assert set(scored(make_songs(rows))) == {"rock"}
    assert scored(make_songs(rows), normalize_genre=False) == {}


def random_songs(seed, count=3000):
    rng = random.Random(seed)
    return [
        (f"t{i}", rng.choice(["a", "b", "c", "d", None]), rng.choice(["x", "X ", "y", "z"]),
         rng.randrange(1950, 2025), rng.randrange(0, 103))
        for i in range(count)
    ]


def test_statistics_equal_plain_aggregates(make_songs):
    songs = make_songs(random_songs(1))
    got = decades.decade_stats(songs, profile="strict", normalize_genre=False)
    kept = songs.where(
        "title IS NOT NULL AND artist IS NOT NULL AND year BETWEEN 1900 AND 2030 AND popularity BETWEEN 1 AND 100"
    ).withColumn("decade", F.expr("CAST(floor(year / 10) * 10 AS BIGINT)"))
    plain = kept.groupBy("genre", "decade").agg(
        F.count("*").alias("n"),
        F.round(F.avg("popularity"), 2).alias("mean"),
        F.round(F.stddev("popularity"), 2).alias("std"),
        F.countDistinct("artist").alias("artists"),
        F.countDistinct("year").alias("years"),
    )
    ours = got.select(
        "genre", "decade", "songs_in_decade", "avg_popularity", "popularity_std", "unique_artists", "years_covered"
    )
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, plain.where("n >= 10").collect()))


def test_years_are_counted_in_buckets_longer_than_a_word(make_songs):
    params = ScoringParams(bucket_years=100, min_songs_per_bucket=1)
    rows = [("t", "a", "g", year, 50) for year in range(1900, 1997)] * 2
    row = decades.decade_stats(make_songs(rows), params).first()
    assert (row["years_covered"], row["decade_end"]) == (97, 1999)


def test_independent_of_order_and_partitions(make_songs):
    rows = random_songs(2)
    first = scored(make_songs(rows).repartition(1))
    again = scored(make_songs(rows[::-1]).repartition(7, "title"))
    assert first == again and first
    assert all(0 <= r["timeless_score"] < 90.8 for r in first.values())


def test_partials_of_two_halves_score_like_the_whole(make_songs):
    rows = random_songs(3)
    whole = scored(make_songs(rows))
    halves = [decades.artist_partials(make_songs(part)) for part in (rows[:1000], rows[1000:])]
    merged = scores_from_partials(halves[0].unionByName(halves[1]))
    assert {r["genre"]: r for r in merged.collect()} == whole


def test_order_is_by_unrounded_score_then_genre(make_songs):
    rows = GOLDEN + genre_rows("a", [(1975, 60, 25), (1985, 64, 25)]) + genre_rows("b", [(1975, 80, 25), (2021, 80, 25)])
    ordered = [r["genre"] for r in scoring.by_score(scoring.timeless_scores(make_songs(rows))).collect()]
    assert ordered == ["b", "a", "g"]


def test_landing_columns(make_songs):
    landed = scoring.score_landing(scoring.timeless_scores(make_songs(GOLDEN)))
    row = landed.first()
    assert str(row["variance_score"]) == "87.10" and str(row["peak_stability"]) == "7.70"
    assert (row["year_span"], row["period_stats"]) == (2, None)
    assert dict(landed.dtypes)["timeless_score"] == "decimal(5,2)"


def test_job_lands_and_summarizes(spark, make_songs, root):
    path = f"{root}/metrics"
    assert run_scoring(spark, make_songs(GOLDEN[:49]), path) is None
    day = F.lit("2024-01-01").cast("date")
    for _ in range(2):
        summary = run_scoring(spark, make_songs(GOLDEN), path, as_of=day)
    assert (summary["total_analyzed"], summary["avg_score"]) == (1, 43.9)
    assert spark.read.parquet(path).count() == 1
    assert [r["decade"] for r in champion_breakdown(spark, make_songs(GOLDEN), path).collect()] == [1970, 1980]
