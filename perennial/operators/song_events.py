"""Live events joined with the songs they name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perennial.functions.text import title_case
from perennial.operators.ranking import top_per_group
from perennial.params import RECENT_EVENTS

LIST_FIELDS = ("event_type", "song_title", "artist", "year", "reason", "boost_amount", "created_at")
SHOWN_EVENTS = 5


def event_type_counts(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type").isNotNull()).groupBy("event_type").count()


def _song_keys(songs: DataFrame) -> DataFrame:
    """One row per (title, artist, genre, year), named apart from the event columns."""
    return songs.select(
        F.col("title").alias("_title"), F.col("artist").alias("_artist"), "genre", "year"
    ).distinct()


def _same_song() -> Column:
    """Title and artist agree; two missing ones agree as well."""
    return F.col("song_title").eqNullSafe(F.col("_title")) & F.col("artist").eqNullSafe(F.col("_artist"))


def _with_songs(events: DataFrame, song_keys: DataFrame) -> DataFrame:
    """Events with genre and year. A song known under two years or genres doubles its
    events; an event without a song has the genre 'Unknown'."""
    joined = events.join(song_keys, _same_song(), "left").drop("_title", "_artist")
    return joined.fillna("Unknown", subset=["genre"])


def event_counts_by_genre(events: DataFrame, songs: DataFrame) -> DataFrame:
    """Events per genre over the whole tables.

    Both sides are counted per song before they meet, so a song with a third of all
    events is one row in the join.
    """
    per_song = events.groupBy("song_title", "artist").agg(F.count(F.lit(1)).alias("n"))
    years = _song_keys(songs).groupBy("_title", "_artist", "genre").agg(F.count(F.lit(1)).alias("years"))
    return (
        _with_songs(per_song, years)
        .groupBy("genre")
        .agg(F.sum(F.col("n") * F.coalesce("years", F.lit(1))).alias("event_count"))
    )


def newest_events_by_genre(events: DataFrame, songs: DataFrame, shown: int = SHOWN_EVENTS) -> DataFrame:
    """The newest events of each genre.

    An event stands in a genre at least as often as any older event of the same song,
    so only the newest few per song can be shown; the others stay out of the join. Of what
    the join makes of them, only the newest hundredth of a genre with many entries is sorted.
    """
    newest_first = [F.col("created_at").desc_nulls_last(), F.col("event_id").desc_nulls_last()]
    per_song = top_per_group(events, ["song_title", "artist"], newest_first, shown, rank="_place")
    keys = _song_keys(songs)
    joined = _with_songs(per_song.drop("_place"), keys)
    since = _newest_since(_with_songs(per_song.select("song_title", "artist", "created_at"), keys), shown)
    joined = joined.join(F.broadcast(since), F.col("genre") == F.col("_genre"))
    recent = joined.where(F.col("_since").isNull() | (F.unix_micros("created_at") >= F.col("_since")))
    order = [*newest_first, F.col("year").desc_nulls_last()]
    return top_per_group(recent.drop("_genre", "_since"), ["genre"], order, shown, rank="place")


def _newest_since(entries: DataFrame, shown: int) -> DataFrame:
    """(_genre, _since): a moment in microseconds since which a genre has ``shown`` entries or
    more, about a hundredth of all; NULL for a genre of few. One row per genre.

    The percentile is off by a thousandth of the entries at most, so at least 0.9 % are kept.
    """
    dated = F.count("created_at")
    since = F.percentile_approx(F.unix_micros("created_at"), 0.99, 1000)
    return entries.groupBy(F.col("genre").alias("_genre")).agg(
        F.when(dated * 0.008 >= shown, since).alias("_since")
    )


def events_by_genre(events: DataFrame, songs: DataFrame, listed: int = RECENT_EVENTS) -> DataFrame:
    """The newest ``listed`` events of each genre as seven lists, newest first, with the
    number of all its events. An event of a song that a genre knows
    under several years is as many entries; without such songs, no event among the newest
    1,000 of all is left out by default."""
    entry = F.struct("place", *LIST_FIELDS)
    lists = (
        newest_events_by_genre(events, songs, listed)
        .groupBy("genre")
        .agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    )
    named = [F.col("entries").getField(name).alias(f"{name}_list") for name in LIST_FIELDS]
    return lists.join(event_counts_by_genre(events, songs), "genre").select("genre", *named, "event_count")


def _or_unknown(text: Column) -> Column:
    return F.when(text.isNull() | (text == ""), F.lit("Unknown")).otherwise(text)


def event_line(line_break: str = "\n") -> Column:
    """Two lines of text per event; reason and boost appear only when there is one."""
    reason = _or_unknown(F.col("reason"))
    return F.concat(
        F.lit("• "), _or_unknown(F.col("song_title")),
        F.lit(" - "), _or_unknown(F.col("artist")),
        F.lit(" ("), F.coalesce(F.col("year").cast("string"), F.lit("Unknown")), F.lit(")"),
        F.lit(f"{line_break}  Event: "), _or_unknown(F.col("event_type")),
        F.when(reason.isin("Unknown", "nan"), "").otherwise(F.concat(F.lit(" ("), reason, F.lit(")"))),
        F.when(F.col("boost_amount") > 0, F.concat(F.lit(" [+"), "boost_amount", F.lit("]"))).otherwise(""),
    )


def event_details(
    events: DataFrame, songs: DataFrame, shown: int = SHOWN_EVENTS, line_break: str = "\n"
) -> DataFrame:
    """Readable text per genre over all events: the newest few, then how many more."""
    lines = (
        newest_events_by_genre(events, songs, shown)
        .groupBy("genre")
        .agg(F.sort_array(F.collect_list(F.struct("place", event_line(line_break).alias("line")))).alias("shown"))
    )
    joined = lines.join(event_counts_by_genre(events, songs), "genre")
    more = F.when(
        F.col("event_count") > shown,
        F.concat(F.lit(f"{line_break}... and "), F.col("event_count") - shown, F.lit(" more")),
    ).otherwise("")
    heading = F.concat(
        title_case(F.col("genre")), F.lit(f"{line_break}Total Events: "), "event_count", F.lit(line_break * 2)
    )
    return joined.select(
        "genre",
        title_case(F.col("genre")).alias("genre_title"),
        "event_count",
        F.concat(heading, F.array_join(F.col("shown.line"), line_break), more).alias("detail_text"),
    )
