"""Songs, song events and raw song cells derived from the star-schema test tables.

The statements use integer arithmetic only, so that any SQL engine gives the same
rows. None of the joins is hinted: part and supplier grow with the data, and the
optimizer broadcasts them only while their measured size allows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perennial.session import spread


def star_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def star_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as an unbounded input. Written as a pattern, the path may be one
    file as well as a folder of files."""
    schema = star_table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def songs_from(lineitem: DataFrame, part: DataFrame, supplier: DataFrame) -> DataFrame:
    spaced = F.concat(F.lit(" "), F.upper("p_brand"), F.lit(" "))
    return (
        lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.col("p_name").alias("title"),
            F.col("s_name").alias("artist"),
            F.when(F.col("l_linenumber") % 3 == 0, spaced).otherwise(F.col("p_brand")).alias("genre"),
            F.year("l_shipdate").alias("year"),
            (F.col("l_quantity") * 2).cast("int").alias("popularity"),
            (F.col("p_size") + 60).alias("bpm"),
            (F.round(F.col("l_discount") * 100).cast("int") * 10).alias("energy"),
            (F.col("p_size") * 2).alias("danceability"),
            F.col("l_quantity").cast("int").alias("valence"),
            (100 - F.col("p_size") * 2).alias("acousticness"),
            (-F.round(F.col("l_tax") * 100).cast("int")).alias("loudness"),
            F.col("l_linenumber").alias("liveness"),
            (F.col("l_quantity").cast("int") + 120).alias("length"),
            (F.col("l_linenumber") * 3).alias("speechiness"),
            F.col("l_shipdate").cast("timestamp").alias("processed_at"),
            F.lit("historical").alias("event_type"),
        )
    )


def _with_parts(spark: SparkSession, sf_dir: str, lineitem: DataFrame) -> DataFrame:
    return songs_from(
        lineitem, star_table(spark, sf_dir, "part"), star_table(spark, sf_dir, "supplier")
    )


def songs(spark: SparkSession, sf_dir: str, spread_out: bool = False) -> DataFrame:
    """One song per line item; ``spread_out`` is for work that is heavy per row."""
    lineitem = star_table(spark, sf_dir, "lineitem")
    return _with_parts(spark, sf_dir, spread(lineitem) if spread_out else lineitem)


def streaming_songs(spark: SparkSession, sf_dir: str, spread_out: bool = False) -> DataFrame:
    lineitem = star_stream(spark, sf_dir, "lineitem")
    if spread_out:
        lineitem = spread(lineitem, sized_like=star_table(spark, sf_dir, "lineitem"))
    return _with_parts(spark, sf_dir, lineitem)


def edge_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same songs with flaws and edge values, and three small genres made from parts.

    A mark in 0..96 from the song's numbers decides its flaw. The brand's number n decides
    the level of popularity (n / 5) and the span of years (n % 5); brand 7 has decades that
    differ so much that it does not qualify.
    """
    n = F.trim("genre").substr(7, 9).cast("int")
    mark = (F.col("valence") * 31 + F.col("danceability") * 7 + F.col("energy") + F.col("liveness")) % 97
    step = F.col("year") - 1995
    span = (
        F.when(n % 5 == 0, 1960 + step * 5)
        .when(n % 5 == 1, 1985 + step * 5)
        .when(n % 5 == 2, 1990 + step * 5)
        .when(n % 5 == 3, 1970 + step)
        .otherwise(1900 + step * 20)
    )
    level = F.floor(F.col("popularity") * (F.floor(n / 5) % 5 + 1) * 2 / 5)
    year = (
        F.when(mark == 8, 1899)
        .when((mark == 9) & (n % 5 == 4), 1900)
        .when((mark == 10) & (n % 5 == 4), 2030)
        .when(mark == 11, 2031)
        .when(mark != 12, span)
    )
    popularity = (
        F.when(mark == 3, 0)
        .when(mark == 4, 1)
        .when(mark == 5, 100)
        .when(mark == 6, 101)
        .when(mark == 7, F.lit(None))
        .when((n == 7) & (span < 2000), 5)
        .when(n == 7, 95)
        .otherwise(F.least(F.lit(100), 1 + level))
    )
    flawed = songs(spark, sf_dir).select(
        F.when(mark != 1, F.col("title")).alias("title"),
        F.when(mark != 2, F.col("artist")).alias("artist"),
        F.when(mark != 0, F.col("genre")).alias("genre"),
        year.cast("int").alias("year"),
        popularity.cast("int").alias("popularity"),
        *("bpm", "energy", "danceability", "valence", "acousticness", "loudness", "liveness", "length"),
        F.lit(3).alias("speechiness"),
        "processed_at",
        "event_type",
    )

    # Edge a: 9 songs in one decade, 25 and 25 in others. Edge b: 10 and 39, 49 in all.
    # Edge c: two decades alike, and a period of two songs.
    key = F.col("p_partkey")
    genre = F.when(key < 59, "edge a").when(key < 108, "edge b").otherwise("edge c")
    year = (
        F.when((key < 9) | key.between(59, 68), 1990)
        .when(key < 59, 1970 + key % 2 * 10)
        .when(key < 108, 1980)
        .when(key < 168, 1980 + key % 2 * 10)
        .otherwise(2015)
    )
    small = star_table(spark, sf_dir, "part").where(key < 170).select(
        F.col("p_name").alias("title"),
        F.concat(F.lit("edge artist "), (key % 7).cast("string")).alias("artist"),
        genre.alias("genre"),
        year.cast("int").alias("year"),
        F.when(key < 108, 50 + key % 20).otherwise(50).cast("int").alias("popularity"),
        *(
            F.lit(value).cast(flawed.schema[name].dataType).alias(name)
            for name, value in (
                ("bpm", 120), ("energy", 50), ("danceability", 50), ("valence", 50), ("acousticness", 50),
                ("loudness", -5), ("liveness", 1), ("length", 200), ("speechiness", 3),
            )
        ),
        F.lit("2020-01-01").cast("timestamp").alias("processed_at"),
        F.lit("historical").alias("event_type"),
    )
    return flawed.unionByName(small)


def surge_songs_from(events: DataFrame, part: DataFrame, supplier: DataFrame) -> DataFrame:
    """One surge per event with the 14 fields of the song it boosts."""
    parts = part.agg(F.count(F.lit(1)).alias("n")).scalar()
    suppliers = supplier.agg(F.count(F.lit(1)).alias("n")).scalar()
    keyed = events.select(
        "event_id",
        "user_id",
        "event_type",
        "ts",
        (F.col("event_id") % parts).alias("part_key"),
        (F.col("user_id") % suppliers).alias("supp_key"),
    )

    def whole(number):
        return number.cast("int")

    popularity = whole(1 + F.col("user_id") % 100)
    return (
        keyed.join(part, F.col("part_key") == F.col("p_partkey"))
        .join(supplier, F.col("supp_key") == F.col("s_suppkey"))
        .select(
            F.col("event_id").cast("string").alias("event_id"),
            F.lit("popularity_surge").alias("event_type"),
            F.when(F.col("event_id") % 10 != 0, F.col("p_name")).alias("song_title"),
            F.col("s_name").alias("artist"),
            F.col("event_type").alias("reason"),
            whole(15 + F.col("event_id") % 26).alias("boost_amount"),
            popularity.alias("original_popularity"),
            F.lit(True).alias("has_timeout"),
            F.col("ts").cast("timestamp").alias("created_at"),
            F.col("p_name").alias("title"),
            F.col("p_brand").alias("top_genre"),
            whole(1960 + F.col("event_id") % 60).alias("year"),
            (F.col("p_size") + 60).alias("bpm"),
            whole(F.col("event_id") % 100).alias("energy"),
            (F.col("p_size") * 2).alias("danceability"),
            whole(-(F.col("user_id") % 20)).alias("loudness"),
            whole(F.col("user_id") % 50).alias("liveness"),
            whole(F.col("event_id") % 90).alias("valence"),
            whole(F.col("event_id") % 300).alias("length"),
            (100 - F.col("p_size") * 2).alias("acousticness"),
            whole(F.col("user_id") % 10).alias("speechiness"),
            popularity.alias("popularity"),
        )
    )


EVENT_COLUMNS = (
    "event_id", "event_type", "song_title", "artist", "reason", "boost_amount",
    "original_popularity", "has_timeout", "created_at",
)


def surge_songs(
    spark: SparkSession, sf_dir: str, streaming: bool = False, spread_out: bool = False
) -> DataFrame:
    """One surge per event; ``spread_out`` is for work that is heavy per row."""
    table = star_table(spark, sf_dir, "events")
    events = star_stream(spark, sf_dir, "events") if streaming else table
    return surge_songs_from(
        spread(events, sized_like=table) if spread_out else events,
        star_table(spark, sf_dir, "part"),
        star_table(spark, sf_dir, "supplier"),
    )


def song_events(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    """Surges as the event table keeps them; every tenth one lacks its title."""
    return surge_songs(spark, sf_dir, streaming).select(*EVENT_COLUMNS)


def raw_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Song cells as text, the way a file delivers them, flaws included.

    By line number: 2 has fractions, 3 a grouped number, 4 a word for the energy,
    5 a missing artist, 6 a blank title, 7 a word for the year.
    """

    def text(column: str):
        return F.col(column).cast("string")

    line = F.col("liveness")  # the adapter's line number
    return songs(spark, sf_dir, spread_out=True).select(
        text("liveness").alias("index"),
        F.when(line == 6, "  ").otherwise(F.concat(F.lit(" "), "title", F.lit("\t"))).alias("title"),
        F.when(line != 5, F.col("artist")).alias("artist"),
        F.col("genre").alias("top_genre"),
        F.when(line == 7, "unknown").otherwise(text("year")).alias("year"),
        text("bpm").alias("bpm"),
        F.when(line == 4, "loud").otherwise(text("energy")).alias("energy"),
        text("danceability").alias("danceability"),
        F.when(line == 2, F.concat(text("loudness"), F.lit(".9")))
        .otherwise(text("loudness"))
        .alias("loudness"),
        text("liveness").alias("liveness"),
        text("valence").alias("valence"),
        F.when(line == 2, F.concat(text("length"), F.lit(".7")))
        .when(line == 3, F.concat(F.lit("1,"), text("length")))
        .otherwise(text("length"))
        .alias("length"),
        text("acousticness").alias("acousticness"),
        text("speechiness").alias("speechiness"),
        text("popularity").alias("popularity"),
    )
