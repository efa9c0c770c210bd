import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from perennial.operators import ranking


def test_newest_equals_a_full_sort(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(40), rng.choice("abc"), rng.randrange(3)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "moment int, name string, n int").repartition(9)
    expected = sorted(rows, key=lambda r: (-r[0], r[1], r[2]))
    for n in (1, 50, 1999, 5000):
        assert [tuple(r) for r in ranking.newest(df, "moment", n).collect()] == expected[:n]


def test_newest_by_time_keeps_ties_gaps_and_all_of_few(spark):
    rng = random.Random(8)
    rows = [(rng.choice([None, *range(30)]), rng.choice("abc")) for _ in range(600)]
    times = [(None if h is None else f"2024-01-01 {h % 24:02}:{h:02}:00", name) for h, name in rows]
    df = spark.createDataFrame(times, "moment string, name string").withColumn(
        "moment", F.col("moment").cast("timestamp")
    )
    expected = sorted(times, key=lambda r: r[1])
    expected.sort(key=lambda r: r[0] or "", reverse=True)
    for n in (1, 40, 590, 1000):
        got = ranking.newest(df.repartition(7), "moment", n).select(F.col("moment").cast("string"), "name")
        assert [tuple(r) for r in got.collect()] == expected[:n]


def test_newest_trims_before_the_shuffle(spark):
    df = spark.range(100_000).withColumn("moment", F.col("id") % 7)
    plan = ranking.newest(df, "moment", 10_000)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.count("Partial") >= 1


def test_row_numbers_by_value(spark, monkeypatch):
    monkeypatch.setattr(ranking, "_ROWS_PER_CHUNK", 3)
    rng = random.Random(6)
    rows = [(rng.choice(["hot", "hot", "x", None]), rng.randrange(4), rng.randrange(2)) for _ in range(300)]
    df = spark.createDataFrame(rows, "genre string, popularity int, year int")
    got = ranking.row_numbers_by_value(df, ["genre"], {"popularity": "desc", "year": "asc"})
    window = Window.partitionBy("genre").orderBy(F.desc("popularity"), "year")
    plain = df.withColumn("rank", F.row_number().over(window).cast("long"))
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, plain.collect()), key=key)


def test_rank_by_score_equals_row_number(spark):
    rng = random.Random(7)
    rows = [(f"g{i}", rng.randrange(0, 30) / 10) for i in range(200)]
    df = spark.createDataFrame(rows, "genre string, timeless_score double").repartition(5)
    got = {r["genre"]: r["ranking"] for r in ranking.rank_by_score(df).collect()}
    expected = sorted(rows, key=lambda r: (-r[1], r[0]))
    assert got == {genre: i + 1 for i, (genre, _) in enumerate(expected)}


def test_equal_scores_rank_by_name_across_beginnings(spark):
    names = [None, "", "a", "ab", "abc", "abcd", "abce", "abd", "b", "éa", "éb", "zz", "zzzz", "Abc"]
    rows = [(n, s) for n in names for s in (1.0, None)]
    df = spark.createDataFrame(rows, "genre string, timeless_score double").repartition(4)
    got = [tuple(r)[:2] for r in ranking.rank_by_score(df).orderBy("ranking").collect()]
    key = lambda r: (r[1] is None, r[0] is not None, (r[0] or "").encode())
    assert got == sorted(rows, key=key)
    assert ranking.rank_by_score(df.limit(0)).count() == 0


def test_rows_without_a_score_rank_last(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0), ("c", None)], "genre string, timeless_score double")
    assert {r["genre"]: r["ranking"] for r in ranking.rank_by_score(df).collect()} == {"b": 1, "a": 2, "c": 3}


def test_top_per_group_breaks_ties(spark):
    rows = [("a", 5, "y"), ("a", 5, "x"), ("a", 1, "z"), ("b", 2, "q")]
    df = spark.createDataFrame(rows, "g string, n int, name string")
    top = ranking.top_per_group(df, ["g"], [F.desc("n"), F.col("name")], 2)
    assert sorted(map(tuple, top.collect())) == [("a", 5, "x", 1), ("a", 5, "y", 2), ("b", 2, "q", 1)]


def test_ranked_top_k(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3), ("c", 3)], "name string, n int")
    top = ranking.ranked_top_k(df, 2, F.desc("n"), F.col("name"))
    assert [tuple(r) for r in top.collect()] == [("b", 3, 1), ("c", 3, 2)]


def test_numbers_of_any_size_are_split_evenly(spark):
    """A third of the rows share a score and the beginning of their names."""
    rows = [(50.0 if k % 3 else k / 1000, f"Brand#{k % 700:04d}", k % 5) for k in range(6000)]
    frame = spark.createDataFrame(rows, "timeless_score double, genre string, kind int").repartition(6)
    numbered = ranking.number_rows(frame, F.col("timeless_score").desc(), F.col("genre"), parts=48)
    got = sorted(numbered.collect(), key=lambda r: r["ranking"])
    assert [r["ranking"] for r in got] == list(range(1, 6001))
    assert [(r[0], r[1]) for r in got] == sorted(((r[0], r[1]) for r in rows), key=lambda r: (-r[0], r[1]))
    parts = ranking._in_order(frame, [F.col("timeless_score").desc(), F.col("genre")], 48)
    largest = parts.groupBy(F.shiftright("_id", 33)).count().agg(F.max("count")).first()[0]
    assert largest <= 0.05 * 6000


def test_equal_rows_are_no_single_part(spark):
    frame = spark.range(4000, numPartitions=8).select(F.lit(1.0).alias("s"), F.lit("x").alias("genre"))
    parts = ranking._in_order(frame, [F.col("s").desc(), F.col("genre")], 32)
    assert parts.groupBy(F.shiftright("_id", 33)).count().count() >= 2
    assert sorted(r["ranking"] for r in ranking.rank_by_score(frame, "s").collect()) == list(range(1, 4001))


def test_ranking_of_nothing_and_of_nulls(spark):
    schema = "timeless_score double, genre string"
    assert ranking.rank_by_score(spark.createDataFrame([], schema)).collect() == []
    found = ranking.rank_by_score(spark.createDataFrame([(None, "a"), (1.0, None), (1.0, "b")], schema)).collect()
    assert {(r[0], r[1]): r[2] for r in found} == {(1.0, None): 1, (1.0, "b"): 2, (None, "a"): 3}
