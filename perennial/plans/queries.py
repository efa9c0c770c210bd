"""Every operator as a query over the star-schema test tables.

Amounts that land as decimal(5,2) are shown as double, and dates and lists as text,
so that results compare by value with those of any other SQL engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from perennial.operators import (
    cleaning,
    decades,
    envelope,
    filters,
    leaderboards,
    ranking,
    reports,
    scoring,
    song_events,
    surges,
    trends,
)
from perennial.params import RECENT_EVENTS, RECENT_SONGS, RECENT_TRENDS, ScoringParams
from perennial.plans.replay_job import in_year_order, replay_messages
from perennial.plans.report_job import report_tables
from perennial.schemas import LANDING_TABLES, SONG_FILE_COLUMNS, SONG_MESSAGE
from perennial.session import scratch_dir, tune
from perennial.sources import star_tables as star
from perennial.sources import tables
from perennial.sources.song_files import read_song_files
from perennial.streaming import expiry, landing, levels, progress, rescoring, timers
from perennial.streaming.control import finish

Query = Callable[[SparkSession, str], DataFrame]

ANALYSIS_DATE = "2024-01-31"
EARLIER_DATE = "2024-01-30"
BREAKDOWN_GENRE = "Brand#12"
TIMELINE_GENRE = "brand#16"

# Two-year buckets give the test dates four periods instead of two decades.
TWO_YEARS = ScoringParams(bucket_years=2, year_end=2003)

STAR_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = lambda spark, sf_dir: run(tune(spark), sf_dir)
    return run


def _day(text: str):
    return F.lit(text).cast("date")


def _doubles(df: DataFrame) -> DataFrame:
    """Decimals as double, dates as text."""
    kinds = dict(df.dtypes)
    casts = {c: F.col(c).cast("double") for c, t in kinds.items() if t.startswith("decimal")}
    casts |= {c: F.col(c).cast("string") for c, t in kinds.items() if t == "date"}
    return df.withColumns(casts) if casts else df


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Today's scores in the shape of their landing table."""
    scores = scoring.timeless_scores(star.songs(spark, sf_dir), as_of=_day(ANALYSIS_DATE))
    return scoring.score_landing(scores).drop("created_at")


def _song_messages(songs: DataFrame) -> DataFrame:
    named = songs.withColumnRenamed("genre", "top_genre")
    return envelope.song_messages(named, F.col("processed_at"))


def _sent_at():
    return F.col("message.timestamp").try_cast("timestamp")


# ------------------------------------------------------------------ cleaning


@query
def clean_songs(spark, sf_dir):
    return cleaning.clean_songs(star.raw_songs(spark, sf_dir))


@query
def clean_songs_drop_policy(spark, sf_dir):
    return cleaning.clean_songs_or_drop(star.raw_songs(spark, sf_dir))


@query
def replayable_songs(spark, sf_dir):
    prepared = cleaning.prepare_songs(star.raw_songs(spark, sf_dir))
    return cleaning.fill_defaults(cleaning.replayable_songs(prepared)).drop("index")


@query
def replay_order(spark, sf_dir):
    """Places of the replay's messages: a year after the other, none with more than two
    tasks' rows in one task."""
    per_task = 5000
    sent = in_year_order(replay_messages(star.raw_songs(spark, sf_dir)), per_task)
    placed = sent.select("year", F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("place"))
    pieces = placed.groupBy("year", "task").agg(
        F.count(F.lit(1)).alias("n"), F.min("place").alias("first"), F.max("place").alias("last")
    )
    years = pieces.groupBy("year").agg(
        F.sum("n").alias("message_count"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        (F.max("n") <= 2 * per_task).alias("split"),
    )
    # One row per calendar year.
    before = F.coalesce(F.lag("last").over(Window.orderBy("year")), F.lit(-1))
    return years.select("year", "message_count", (F.col("first") > before).alias("in_order"), "split")


@query
def strict_filter(spark, sf_dir):
    return filters.with_decade(filters.strict_filter(star.songs(spark, sf_dir)))


@query
def lenient_filter(spark, sf_dir):
    return filters.with_decade(filters.lenient_filter(star.songs(spark, sf_dir)))


# ------------------------------------------------------------------- scoring


@query
def decade_stats(spark, sf_dir):
    return decades.decade_stats(star.songs(spark, sf_dir))


@query
def genre_summary(spark, sf_dir):
    return decades.genre_summary(decades.decade_stats(star.songs(spark, sf_dir)))


@query
def genre_decade_list(spark, sf_dir):
    stats = decades.decade_stats(star.songs(spark, sf_dir), TWO_YEARS)
    return decades.decade_list_text(decades.genre_summary(stats, TWO_YEARS, with_detail=True))


@query
def timeless_scores(spark, sf_dir):
    scores = scoring.timeless_scores(star.songs(spark, sf_dir), as_of=_day(ANALYSIS_DATE))
    return _doubles(scoring.by_score(scores))


@query
def timeless_scores_2y(spark, sf_dir):
    songs = star.songs(spark, sf_dir)
    return _doubles(scoring.timeless_scores(songs, TWO_YEARS, as_of=_day(ANALYSIS_DATE)))


@query
def timeless_scores_strict(spark, sf_dir):
    """Complete songs only, genres as they are spelled."""
    songs = star.songs(spark, sf_dir)
    scores = scoring.timeless_scores(
        songs, profile="strict", normalize_genre=False, as_of=_day(ANALYSIS_DATE)
    )
    return _doubles(scores)


@query
def score_landing(spark, sf_dir):
    return _doubles(_metrics(spark, sf_dir))


@query
def score_summary(spark, sf_dir):
    return scoring.score_summary(scoring.timeless_scores(star.songs(spark, sf_dir)))


# ------------------------------------------------------------ score reports


@query
def ranked_snapshot(spark, sf_dir):
    """Two days of scores are landed; only the newer day ranks."""
    path = scratch_dir(spark, "metrics")
    songs = star.songs(spark, sf_dir)
    for params, day in ((TWO_YEARS, EARLIER_DATE), (ScoringParams(), ANALYSIS_DATE)):
        scores = scoring.timeless_scores(songs, params, as_of=_day(day))
        tables.replace_days(scoring.score_landing(scores).drop("created_at"), path)
    return _doubles(reports.ranked_snapshot(spark.read.parquet(path)))


@query
def champion(spark, sf_dir):
    return reports.champion(_metrics(spark, sf_dir))


@query
def top_rankings(spark, sf_dir):
    return _doubles(reports.top_rankings(_metrics(spark, sf_dir)))


@query
def summary_table(spark, sf_dir):
    return reports.summary_table(_metrics(spark, sf_dir))


@query
def picker_options(spark, sf_dir):
    return reports.picker_options(_metrics(spark, sf_dir))


@query
def score_components_long(spark, sf_dir):
    return reports.score_components_long(_metrics(spark, sf_dir))


@query
def score_histogram(spark, sf_dir):
    return reports.score_histogram(_metrics(spark, sf_dir))


@query
def genre_breakdown(spark, sf_dir):
    return reports.genre_breakdown(star.songs(spark, sf_dir), BREAKDOWN_GENRE)


@query
def genre_timeline(spark, sf_dir):
    return reports.genre_timeline(star.songs(spark, sf_dir), _metrics(spark, sf_dir))


@query
def timeline_of_genre(spark, sf_dir):
    metrics = filters.of_genre(_metrics(spark, sf_dir), TIMELINE_GENRE, any_case=True)
    songs = filters.of_genre(star.songs(spark, sf_dir), TIMELINE_GENRE, any_case=True)
    timeline = reports.genre_timeline(songs, metrics, k=None)
    return reports.timeline_of_genre(timeline, metrics, TIMELINE_GENRE)


# -------------------------------------------------------------- song reports


@query
def genre_window_trends(spark, sf_dir):
    found = trends.genre_trends(star.songs(spark, sf_dir), exact_artists=True)
    return found.select(
        "genre",
        F.col("time_window.start").alias("window_start"),
        F.col("time_window.end").alias("window_end"),
        "song_count",
        "avg_popularity",
        F.round("std_popularity", 6).alias("std_popularity"),
        "max_popularity",
        "min_popularity",
        "unique_artists",
    )


@query
def trend_landing(spark, sf_dir):
    found = trends.genre_trends(star.songs(spark, sf_dir), exact_artists=True)
    return _doubles(trends.trend_landing(found))


@query
def trend_rollup(spark, sf_dir):
    landed = trends.trend_landing(trends.genre_trends(star.songs(spark, sf_dir)))
    return trends.trend_rollup(landed)


@query
def popularity_10min(spark, sf_dir):
    return trends.popularity_over_time(star.songs(spark, sf_dir))


@query
def audio_features(spark, sf_dir):
    return trends.audio_features(star.songs(spark, sf_dir))


@query
def audio_features_long(spark, sf_dir):
    return trends.audio_features_long(trends.audio_features(star.songs(spark, sf_dir)))


@query
def top_genres_by_rows(spark, sf_dir):
    return trends.top_genres_by_rows(star.songs(spark, sf_dir)).withColumnRenamed("count", "song_count")


@query
def catalog_totals(spark, sf_dir):
    return reports.catalog_totals(
        star.songs(spark, sf_dir),
        scoring.timeless_scores(star.songs(spark, sf_dir), as_of=_day(ANALYSIS_DATE)),
    )


def _reports(spark, sf_dir):
    songs = star.songs(spark, sf_dir)
    landed = trends.trend_landing(trends.genre_trends(songs, exact_artists=True))
    # Two versions of every window, as a stream leaves them; the newer one counts.
    older = landed.withColumn("song_count", F.lit(0).cast("long")).withColumn("batch_id", F.lit(0))
    versions = older.unionByName(landed.withColumn("batch_id", F.lit(1)))
    return report_tables(songs, versions, star.song_events(spark, sf_dir), _metrics(spark, sf_dir))


@query
def report_totals(spark, sf_dir):
    return _reports(spark, sf_dir)["totals"]


@query
def report_event_details(spark, sf_dir):
    return _reports(spark, sf_dir)["event_details"]


@query
def report_trend_rollup(spark, sf_dir):
    return _reports(spark, sf_dir)["genre_trends"]


@query
def year_range(spark, sf_dir):
    return reports.year_range(filters.strict_filter(star.songs(spark, sf_dir)))


@query
def table_counts(spark, sf_dir):
    return tables.table_counts({n: star.star_table(spark, sf_dir, n) for n in STAR_TABLES})


@query
def smoke_group(spark, sf_dir):
    return reports.genre_overview(star.songs(spark, sf_dir))


@query
def smoke_row_number(spark, sf_dir):
    songs = star.songs(spark, sf_dir)
    return ranking.row_numbers_by_value(songs, ["genre"], {"popularity": "desc", "year": "desc"})


@query
def recent_songs(spark, sf_dir):
    return ranking.newest(star.songs(spark, sf_dir), "processed_at", RECENT_SONGS)


@query
def recent_trends(spark, sf_dir):
    found = trends.genre_trends(star.songs(spark, sf_dir), exact_artists=True)
    return _doubles(ranking.newest(trends.trend_landing(found), "analysis_window", RECENT_TRENDS))


@query
def recent_events(spark, sf_dir):
    return ranking.newest(star.song_events(spark, sf_dir), "created_at", RECENT_EVENTS)


# ------------------------------------------------------- files, tables, views


@query
def song_file_scan(spark, sf_dir):
    """Raw songs through CSV files with the header names and back, then cleaned."""
    folder = scratch_dir(spark, "files")
    named = star.raw_songs(spark, sf_dir).withColumnsRenamed({c: h for h, c in SONG_FILE_COLUMNS.items()})
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    named.write.options(header=True, escape='"', **blanks).csv(folder)
    return cleaning.clean_songs(read_song_files(spark, folder))


# Some 400 MB in a file, which is read in several parts.
_FILE_SONGS = 2_000_000


@query
def song_file_split_scan(spark, sf_dir):
    """The same songs through one file, or several if there are millions, a column of quotes and
    line breaks beside them, that are read in parts."""
    folder = scratch_dir(spark, "files")
    files = -(-star.star_table(spark, sf_dir, "lineitem").count() // _FILE_SONGS) or 1
    named = star.raw_songs(spark, sf_dir).withColumnsRenamed({c: h for h, c in SONG_FILE_COLUMNS.items()})
    note = F.concat(F.lit('a "note",\n'), F.lit("of several lines\n\n"), F.col(named.columns[0]))
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    named.withColumn("Note", note).coalesce(files).write.options(header=True, escape='"', **blanks).csv(folder)
    return cleaning.clean_songs(read_song_files(spark, folder, split=True))


@query
def songs_in_year_order(spark, sf_dir):
    """Places of the songs sorted by year: every year begins after the one before it."""
    ordered = cleaning.prepare_songs(star.raw_songs(spark, sf_dir), ordered=True)
    year = F.coalesce("year", F.lit(9999)).cast("int").alias("year")
    placed = ordered.select(year, F.monotonically_increasing_id().alias("place"))
    years = placed.groupBy("year").agg(
        F.count(F.lit(1)).alias("song_count"), F.min("place").alias("first"), F.max("place").alias("last")
    )
    before = F.coalesce(F.lag("last").over(Window.orderBy("year")), F.lit(-1))
    return years.select("year", "song_count", (F.col("first") > before).alias("in_order"))


@query
def attribute_sums_in_order(spark, sf_dir):
    """Places of the sorted sums: by attribute and year, the largest sum first."""
    songs = star.songs(spark, sf_dir).withColumnRenamed("genre", "top_genre")
    sums = leaderboards.attribute_year_sums(songs, ordered=True)
    placed = sums.withColumn("place", F.monotonically_increasing_id())
    groups = placed.groupBy("attribute", "year").agg(
        F.count(F.lit(1)).alias("value_count"),
        F.min("place").alias("first"),
        F.max("place").alias("last"),
        (F.min_by("total", "place") == F.max("total")).alias("best_first"),
        (F.max_by("total", "place") == F.min("total")).alias("least_last"),
    )
    before = F.coalesce(F.lag("last").over(Window.orderBy("attribute", "year")), F.lit(-1))
    in_order = F.col("best_first") & F.col("least_last") & (F.col("first") > before)
    return groups.select("attribute", "year", "value_count", in_order.alias("in_order"))


@query
def view_counts(spark, sf_dir):
    """Songs and events under the names of views, joined by SQL."""
    tables.register_views(
        {"catalog_songs": star.songs(spark, sf_dir), "catalog_events": star.song_events(spark, sf_dir)}
    )
    return spark.sql(
        """SELECT s.artist, song_count, coalesce(event_count, 0) AS event_count
        FROM (SELECT artist, count(*) AS song_count FROM catalog_songs GROUP BY artist) s
        LEFT JOIN (SELECT artist, count(*) AS event_count FROM catalog_events GROUP BY artist) e
        ON s.artist = e.artist"""
    )


@query
def landing_table_counts(spark, sf_dir):
    """Landing tables made empty, appended to and counted; one root is truncated again."""
    filled, emptied = scratch_dir(spark, "filled"), scratch_dir(spark, "emptied")
    for root in (filled, emptied):
        tables.create_tables(spark, root)
        tables.append_rows(star.songs(spark, sf_dir), root, "song_analytics")
        tables.append_rows(star.song_events(spark, sf_dir), root, "real_time_events")
    tables.truncate_tables(spark, emptied)
    found = {name: tables.read_table(spark, filled, name) for name in LANDING_TABLES}
    found |= {f"emptied {name}": tables.read_table(spark, emptied, name) for name in LANDING_TABLES}
    return tables.table_counts(found)


@query
def minimum_data_gate(spark, sf_dir):
    """Genres on both sides of the fifty songs that scoring asks for."""
    songs = star.edge_songs(spark, sf_dir)

    def gate(genre):
        kept = filters.of_genre(songs, genre)
        enough = filters.has_rows(kept, ScoringParams().min_total_songs)
        return kept.agg(F.count(F.lit(1)).alias("song_count")).select(
            F.lit(genre).alias("genre"), F.lit(enough).alias("enough"), "song_count"
        )

    return gate("edge a").unionByName(gate("edge b"))


@query
def new_event_ids(spark, sf_dir):
    """Identifiers drawn once for every song and written down: all differ."""
    path = scratch_dir(spark, "ids")
    surges.new_event_ids(star.songs(spark, sf_dir).select("title")).write.parquet(path)
    drawn = spark.read.parquet(path).groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))
    return drawn.agg(
        F.sum("n").alias("song_count"),
        F.count(F.lit(1)).alias("id_count"),
        F.max(F.length("event_id")).alias("id_length"),
    )


@query
def stamped_events(spark, sf_dir):
    """Events without a given time take the time at which they are read; rollbacks that are
    not correlated have neither id nor boost."""
    given = star.surge_songs(spark, sf_dir, spread_out=True)
    sent = surges.surge_messages(given).unionByName(surges.rollback_messages(given))
    flat = envelope.flatten_events(envelope.parse_messages(sent), correlate=False)
    near = F.abs(F.unix_timestamp("processed_at") - F.unix_timestamp(F.current_timestamp())) < 60
    return flat.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count("event_id").alias("id_count"),
        F.sum("boost_amount").alias("boost"),
        F.bool_and(near).alias("stamped"),
    )


# ------------------------------------------------------------- leaderboards


def _attribute_sums(spark, sf_dir):
    songs = star.songs(spark, sf_dir).withColumnRenamed("genre", "top_genre")
    return leaderboards.attribute_year_sums(songs)


@query
def attribute_year_sums(spark, sf_dir):
    return _attribute_sums(spark, sf_dir)


@query
def attribute_year_totals(spark, sf_dir):
    return leaderboards.attribute_year_totals(_attribute_sums(spark, sf_dir))


@query
def attribute_top10(spark, sf_dir):
    return leaderboards.attribute_top(_attribute_sums(spark, sf_dir), 10, every=5)


@query
def attribute_heatmap(spark, sf_dir):
    years = leaderboards.year_list(star.songs(spark, sf_dir))
    return leaderboards.heatmap_rows(_attribute_sums(spark, sf_dir), years)


# ------------------------------------ songs with gaps and values on the limits


@query
def strict_filter_edges(spark, sf_dir):
    return filters.with_decade(filters.strict_filter(star.edge_songs(spark, sf_dir)))


@query
def lenient_filter_edges(spark, sf_dir):
    return filters.with_decade(filters.lenient_filter(star.edge_songs(spark, sf_dir)))


@query
def decade_stats_edges(spark, sf_dir):
    return decades.decade_stats(star.edge_songs(spark, sf_dir))


@query
def genre_summary_edges(spark, sf_dir):
    return decades.genre_summary(decades.decade_stats(star.edge_songs(spark, sf_dir)))


@query
def timeless_scores_edges(spark, sf_dir):
    return _doubles(scoring.timeless_scores(star.edge_songs(spark, sf_dir), as_of=_day(ANALYSIS_DATE)))


@query
def timeless_scores_strict_edges(spark, sf_dir):
    scores = scoring.timeless_scores(
        star.edge_songs(spark, sf_dir), profile="strict", normalize_genre=False, as_of=_day(ANALYSIS_DATE)
    )
    return _doubles(scores)


@query
def trend_landing_edges(spark, sf_dir):
    found = trends.genre_trends(star.edge_songs(spark, sf_dir), exact_artists=True)
    return _doubles(trends.trend_landing(found))


@query
def genre_timeline_edges(spark, sf_dir):
    songs = star.edge_songs(spark, sf_dir)
    metrics = scoring.score_landing(scoring.timeless_scores(songs, as_of=_day(ANALYSIS_DATE)))
    return reports.genre_timeline(songs, metrics, k=None)


@query
def attribute_heatmap_edges(spark, sf_dir):
    """One attribute has a single value and so no heat map."""
    songs = filters.lenient_filter(star.edge_songs(spark, sf_dir))
    sums = leaderboards.attribute_year_sums(songs.withColumnRenamed("genre", "top_genre"))
    return leaderboards.heatmap_rows(sums, leaderboards.year_list(songs))


# ------------------------------------------------------------- event reports


@query
def event_type_counts(spark, sf_dir):
    given = star.song_events(spark, sf_dir)
    both = surges.surges_and_rollbacks(given, surges.surge_rollbacks(given))
    return song_events.event_type_counts(both).withColumnRenamed("count", "event_count")


@query
def events_by_genre(spark, sf_dir):
    grouped = song_events.events_by_genre(star.song_events(spark, sf_dir), star.songs(spark, sf_dir))

    def text(name):
        def show(item):
            if name == "created_at":
                return F.date_format(item, "yyyy-MM-dd HH:mm:ss.SSSSSS")
            return F.coalesce(item.cast("string"), F.lit(""))

        return F.array_join(F.transform(f"{name}_list", show), "|").alias(f"{name}_list")

    return grouped.select("genre", *[text(n) for n in song_events.LIST_FIELDS], "event_count")


@query
def event_counts_by_genre(spark, sf_dir):
    return song_events.event_counts_by_genre(star.song_events(spark, sf_dir), star.songs(spark, sf_dir))


@query
def event_details(spark, sf_dir):
    return song_events.event_details(star.song_events(spark, sf_dir), star.songs(spark, sf_dir))


# ---------------------------------------------------- messages and surges


@query
def song_messages(spark, sf_dir):
    return _song_messages(star.songs(spark, sf_dir, spread_out=True))


@query
def song_json_flatten(spark, sf_dir):
    parsed = envelope.parse_messages(_song_messages(star.songs(spark, sf_dir, spread_out=True)), SONG_MESSAGE)
    return envelope.song_landing(envelope.flatten_songs(parsed, now=_sent_at()))


@query
def event_json_flatten(spark, sf_dir):
    given = star.surge_songs(spark, sf_dir, spread_out=True)
    sent = surges.surge_messages(given).unionByName(surges.rollback_messages(given))
    flat = envelope.flatten_events(envelope.parse_messages(sent), now=_sent_at())
    return envelope.event_landing(flat)


@query
def surge_boost(spark, sf_dir):
    return surges.surge_boost(star.song_events(spark, sf_dir))


@query
def surge_rollbacks(spark, sf_dir):
    return surges.surge_rollbacks(star.song_events(spark, sf_dir))


@query
def surges_and_rollbacks(spark, sf_dir):
    given = star.song_events(spark, sf_dir)
    both = surges.surges_and_rollbacks(given, surges.surge_rollbacks(given))
    return both.select("event_type", "event_id", "original_event_id", "boost_amount", "created_at")


@query
def matched_rollbacks(spark, sf_dir):
    given = star.song_events(spark, sf_dir)
    return surges.matched_rollbacks(given, surges.surge_rollbacks(given)).select(
        "event_id", "created_at", "rolled_back_at", "original_boost"
    )


# ------------------------------------------------------------------- streams


def _run(stream, sink, root, output_mode="append"):
    finish(landing.start_query(stream, sink, f"{root}/checkpoint", output_mode=output_mode))


def _artists_close(landed, songs):
    """Landed trends; the estimated artists are held against the exact ones, within 5 % or one."""
    exact = trends.trend_landing(trends.genre_trends(songs, exact_artists=True)).select(
        "genre", "analysis_window", F.col("unique_artists").alias("exact")
    )
    close = F.abs(F.col("unique_artists") - F.col("exact")) <= F.greatest(F.lit(1), F.col("exact") * 0.05)
    joined = landed.join(exact, ["genre", "analysis_window"]).withColumn("artists_close", close)
    return _doubles(joined.drop("unique_artists", "exact"))


# Rows in a file, which one task writes and reads.
_FILE_ROWS = 100_000


def _in_files(rows, root, table, batches=8):
    """A stream of ``rows`` in no order of time, in so many batches. There is about one row for
    each of ``table``; if there are many, a batch is several files for several tasks."""
    files = -(-table.count() // (batches * _FILE_ROWS)) or 1
    rows.repartition(batches * files).write.parquet(root)
    return rows.sparkSession.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(root)


@query
def stream_genre_trends(spark, sf_dir):
    """Eight batches in no order of time, their sums merged three at a time."""
    root = scratch_dir(spark, "trends")
    songs = star.songs(spark, sf_dir).select("genre", "artist", "popularity", "processed_at")
    stream = _in_files(songs, f"{root}/songs", star.star_table(spark, sf_dir, "lineitem"))
    sink = levels.levelled_sink(spark, f"{root}/rows", trends.trend_partials, trends.added_partials, fanout=3)
    _run(stream, sink, root)
    merged = trends.merge_trends(levels.read_levels(spark, f"{root}/rows", fanout=3))
    return _artists_close(trends.trend_landing(merged), songs)


@query
def stream_trend_updates(spark, sf_dir):
    """Windows kept in the state and sent on as they change, in eight batches. The query stops
    once a batch has landed but is not yet noted as done, starts again from its checkpoint, and
    repeats it; the newest version of each window counts."""
    root = scratch_dir(spark, "updates")
    songs = star.songs(spark, sf_dir).select("genre", "artist", "popularity", "processed_at")
    found = trends.genre_trends(_in_files(songs, f"{root}/songs", star.star_table(spark, sf_dir, "lineitem")))
    land = landing.folder_sink(f"{root}/rows", trends.trend_landing)

    def stopping(batch, batch_id):
        land(batch, batch_id)
        if batch_id == 3:
            raise RuntimeError("stopped after landing")

    try:
        _run(found, stopping, root, "update")
    except StreamingQueryException as stopped:
        if "stopped after landing" not in str(stopped):
            raise
    _run(found, land, root, "update")
    newest = landing.latest_versions(landing.landed(spark, f"{root}/rows"), ["genre", "analysis_window"])
    return _artists_close(newest, songs)


@query
def stream_progress_log(spark, sf_dir):
    """Two streams whose progress lands as a table: eight batches of events, and songs whose
    fourth batch fails."""
    root = scratch_dir(spark, "progress")
    songs = star.songs(spark, sf_dir).select("title", "genre", "popularity")
    events = star.song_events(spark, sf_dir).select("event_id", "boost_amount")
    land = landing.folder_sink(f"{root}/rows/name=songs")

    def failing(batch, batch_id):
        if batch_id == 3:
            raise RuntimeError("fourth batch")
        land(batch, batch_id)

    log = progress.ProgressLog(spark, f"{root}/log")
    spark.streams.addListener(log)
    try:
        runs = [
            landing.start_query(
                _in_files(rows, f"{root}/{name}", star.star_table(spark, sf_dir, table)), sink, f"{root}/{name}_checkpoint", name=name
            )
            for name, rows, table, sink in (
                ("songs", songs, "lineitem", failing),
                ("events", events, "events", landing.folder_sink(f"{root}/rows/name=events")),
            )
        ]
        for run in runs:
            try:
                finish(run)
            except StreamingQueryException as stopped:
                if "fourth batch" not in str(stopped):
                    raise
        log.wait_for_end([run.runId for run in runs])
    finally:
        spark.streams.removeListener(log)
    counts = [
        landing.landed(spark, f"{root}/rows/name={name}").agg(F.count(F.lit(1)).alias("landed_rows")).withColumn("name", F.lit(name))
        for name in ("songs", "events")
    ]
    states = progress.run_states(progress.progress_rows(spark, f"{root}/log"))
    states = states.join(counts[0].unionByName(counts[1]), "name")
    return states.select(
        "name",
        "batches",
        F.when(~F.col("failed"), F.col("input_rows")).alias("input_rows"),
        (F.col("input_rows") == F.col("landed_rows")).alias("all_landed"),
        "ended",
        "failed",
        F.coalesce(F.col("failure").contains("fourth batch"), F.lit(False)).alias("failure_noted"),
    )


@query
def stream_song_landing(spark, sf_dir):
    root = scratch_dir(spark, "songs")
    sent = _song_messages(star.streaming_songs(spark, sf_dir, spread_out=True))
    flat = envelope.flatten_songs(envelope.parse_messages(sent, SONG_MESSAGE), now=_sent_at())
    _run(flat, landing.folder_sink(f"{root}/rows", envelope.song_landing), root)
    return landing.landed(spark, f"{root}/rows").drop("batch_id")


@query
def stream_event_landing(spark, sf_dir):
    root = scratch_dir(spark, "events")
    sent = surges.surge_messages(star.surge_songs(spark, sf_dir, streaming=True, spread_out=True))
    flat = envelope.flatten_events(envelope.parse_messages(sent), now=_sent_at())
    _run(flat, landing.folder_sink(f"{root}/rows", envelope.event_landing), root)
    return landing.landed(spark, f"{root}/rows").drop("batch_id")


# The test events are a month in eight batches.
_DAY = 86_400


@query
def stream_surge_expiry(spark, sf_dir):
    """Eight batches in no order of time, then the end of the stream: all surges end."""
    root = scratch_dir(spark, "expiry")
    stream = _in_files(star.song_events(spark, sf_dir), f"{root}/events", star.star_table(spark, sf_dir, "events"))
    sink = expiry.expiry_sink(spark, f"{root}/rows", slice_seconds=_DAY, remember_seconds=60 * _DAY)
    _run(stream, sink, root)
    expiry.flush_surges(spark, f"{root}/rows", slice_seconds=_DAY)
    return surges.surge_rollbacks(expiry.landed_ends(spark, f"{root}/rows"))


@query
def stream_surge_timers(spark, sf_dir):
    """Eight batches in no order of time, ended by timers; at the end the state's live surges."""
    root = scratch_dir(spark, "timers")
    stream = _in_files(star.song_events(spark, sf_dir), f"{root}/events", star.star_table(spark, sf_dir, "events"))
    ended = timers.ended_by_timers(stream, buckets=32, slot_seconds=30 * _DAY)
    with timers.state_partitions(spark, 32):
        _run(surges.surge_rollbacks(ended), landing.folder_sink(f"{root}/rows"), root)
    ended = landing.landed(spark, f"{root}/rows").drop("batch_id")
    left = timers.live_by_timers(spark, f"{root}/checkpoint", stream)
    return ended.unionByName(surges.surge_rollbacks(left))


def _by_time(rows, moment, bounds, root):
    """A stream of ``rows`` in order of time, a file per span between ``bounds``, and one
    row long after them in which only the moment is set. All tasks deal the rows to their
    spans; a span's own are then put together, one span after the other."""
    span = F.lit(0)
    for bound in bounds:
        span = span + (F.col(moment) >= F.lit(bound)).cast("int")
    # Without a moment a row is in no span, unless there is but one.
    dealt = rows.withColumn("span", span).where("span IS NOT NULL")
    dealt.write.partitionBy("span").parquet(f"{root}_dealt")
    dealt = rows.sparkSession.read.schema(dealt.schema).parquet(f"{root}_dealt")
    for number in range(len(bounds) + 1):
        dealt.where(F.col("span") == number).drop("span").coalesce(1).write.parquet(f"{root}/{number}")
    end = rows.agg((F.max(moment) + F.make_dt_interval(days=F.lit(1))).alias(moment))
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema if f.name != moment]
    end.select(moment, *empty).select(rows.columns).write.parquet(f"{root}/end")
    return rows.sparkSession.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/*")


@query
def stream_matched_rollbacks(spark, sf_dir):
    """Eight batches in order of time. Every seventh surge has no rollback; every eleventh one
    is taken back two minutes late, which is no match."""
    root = scratch_dir(spark, "matches")
    star.song_events(spark, sf_dir).write.parquet(f"{root}/events")
    events = spark.read.parquet(f"{root}/events")
    given = events.select("event_id", "reason", "boost_amount", "created_at")
    number = F.col("original_event_id").cast("long")
    back = surges.surge_rollbacks(events).where(number % 7 != 0)
    late = F.when(number % 11 == 0, 120).otherwise(0)
    back = back.select(
        "original_event_id", "original_boost", (F.col("created_at") + F.make_dt_interval(secs=late)).alias("created_at")
    )
    eighths = [k / 8 for k in range(1, 8)]
    micros = F.percentile_approx(F.unix_micros("created_at"), eighths, 1000)
    bounds = given.select(F.transform(micros, lambda m: F.timestamp_micros(m)).alias("bounds")).first()["bounds"]
    matches = surges.stream_rollback_matches(
        _by_time(given, "created_at", bounds, f"{root}/surges"),
        _by_time(back, "created_at", bounds, f"{root}/rollbacks"),
        lateness_seconds=3600,
    )
    _run(matches, landing.folder_sink(f"{root}/rows"), root)
    return landing.landed(spark, f"{root}/rows").drop("batch_id")


@query
def stream_rescoring(spark, sf_dir):
    root = scratch_dir(spark, "scores")
    sink = rescoring.rescoring_sink(
        spark, f"{root}/partials", f"{root}/scores", as_of=_day(ANALYSIS_DATE)
    )
    _run(star.streaming_songs(spark, sf_dir), sink, root)
    return _doubles(spark.read.parquet(f"{root}/scores").drop("created_at"))
