import datetime

import pytest
from pyspark.sql import functions as F

from perennial.schemas import LANDING_TABLES
from perennial.session import RUNTIME_DEFAULTS, scratch_dir, spread, tune
from perennial.operators.filters import has_rows
from perennial.sources import jdbc, kafka, star_tables, tables


def test_jdbc_options():
    assert jdbc.jdbc_options("jdbc:x", table="songs", user="u") == {"url": "jdbc:x", "user": "u", "dbtable": "songs"}
    assert jdbc.jdbc_options("jdbc:x", query="SELECT 1")["query"] == "SELECT 1"
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x")
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x", table="a", query="b")


def test_jdbc_split():
    split = jdbc.split_options("id", 1, 1000, 8)
    assert split["partitionColumn"] == "id" and split["numPartitions"] == "8"
    with pytest.raises(ValueError):
        jdbc.split_options("id", 5, 5, 8)


def test_kafka_options():
    options = kafka.source_options("host:1", "topic", "earliest", max_offsets_per_trigger=100)
    assert options["startingOffsets"] == "earliest" and options["failOnDataLoss"] == "false"
    assert options["maxOffsetsPerTrigger"] == "100"
    sink = kafka.sink_options("host:1", "topic")
    assert sink["topic"] == "topic" and sink["kafka.acks"] == "all"


def test_kafka_frame(spark):
    df = spark.createDataFrame([("a", 1)], "name string, n int")
    row = kafka.messages(df, F.col("name"), F.struct("name", "n")).first()
    assert tuple(row) == ("a", '{"name":"a","n":1}')


def test_create_append_count_truncate(spark, root):
    tables.create_tables(spark, root)
    rows = spark.createDataFrame([("t", 5)], "title string, popularity long")
    tables.append_rows(rows, root, "song_analytics")
    tables.append_rows(rows, root, "song_analytics")
    frames = {name: tables.read_table(spark, root, name) for name in LANDING_TABLES}
    assert {tuple(r) for r in tables.table_counts(frames).collect()} == {
        ("song_analytics", 2), ("genre_trends", 0), ("real_time_events", 0), ("timeless_genre_metrics", 0),
    }
    assert frames["song_analytics"].schema == LANDING_TABLES["song_analytics"]
    assert tables.preview(frames["song_analytics"], 1).count() == 1
    tables.truncate_tables(spark, root)
    assert tables.read_table(spark, root, "song_analytics").count() == 0


def test_replace_days_touches_only_its_days(spark, root):
    def day(n, genre):
        return spark.createDataFrame([(genre, datetime.date(2024, 1, n))], "genre string, analysis_date date")

    path = f"{root}/metrics"
    for frame in (day(1, "a"), day(2, "b"), day(2, "c")):
        tables.replace_days(frame, path)
    got = {(r["genre"], r["analysis_date"].day) for r in spark.read.parquet(path).collect()}
    assert got == {("a", 1), ("c", 2)}


def test_a_day_is_replaced_by_nothing_too(spark, root):
    rows = [("a", datetime.date(2024, 1, 1)), ("b", datetime.date(2024, 1, 2))]
    df, path = spark.createDataFrame(rows, "genre string, analysis_date date"), f"{root}/metrics"
    for day in ("2024-01-01", "2024-01-02"):
        tables.replace_day(df, path, day)
    tables.replace_day(df.limit(0), path, "2024-01-02")
    assert [(r["genre"], str(r["analysis_date"])) for r in spark.read.parquet(path).collect()] == [("a", "2024-01-01")]


def test_views(spark):
    tables.register_views({"some_songs": spark.range(3)})
    assert spark.sql("SELECT count(*) AS n FROM some_songs").first()["n"] == 3


def test_tune_keeps_what_the_user_chose(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "7m")
    tune(spark, shuffle_bytes=10 * 1024**4)
    assert spark.conf.get(key) == "7m"
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == "40960"
    spark.conf.set(key, RUNTIME_DEFAULTS[key])
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")


def test_scratch_follows_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second
    if shared:
        assert first.startswith(shared)


def test_spread_only_widens(spark):
    cores = spark.sparkContext.defaultParallelism
    narrow, wide = spark.range(10).coalesce(1), spark.range(0, 100, 1, cores + 1)
    assert spread(narrow).rdd.getNumPartitions() == cores
    assert spread(wide) is wide


def test_has_rows(spark):
    df = spark.range(0, 20, 1, 7)
    assert has_rows(df, 0) and has_rows(df, 20) and not has_rows(df, 21)


def test_stream_of_a_table_kept_as_a_folder(spark, root):
    spark.range(30).repartition(3).write.parquet(f"{root}/lineitem.parquet")
    counts = []
    query = (
        star_tables.star_stream(spark, root, "lineitem")
        .writeStream.foreachBatch(lambda batch, _id: counts.append(batch.count()))
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    assert query.awaitTermination(60) and sum(counts) == 30


def test_hot_key_join_is_split(spark, root):
    """A third of the rows share one key; the adaptive join splits that partition."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "60k"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000)
        left = spark.range(0, 300_000, 1, 8).select(hot.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        right = spark.range(1000).withColumnRenamed("id", "k")
        joined = left.join(right, "k")
        assert len(joined.collect()) == 300_000
        assert "skew" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
