"""The same queries as SQL text for an independent engine.

Rounding goes through the shortest decimal form of a double, half up, which is what
Spark does; casts pin the integer widths.
"""

from __future__ import annotations

SONGS = """
songs AS (
  SELECT p_name AS title, s_name AS artist,
         CASE WHEN l_linenumber % 3 = 0 THEN concat(' ', upper(p_brand), ' ') ELSE p_brand END AS genre,
         CAST(year(l_shipdate) AS INTEGER) AS year,
         CAST(l_quantity * 2 AS INTEGER) AS popularity,
         p_size + 60 AS bpm, CAST(round(l_discount * 100) AS INTEGER) * 10 AS energy,
         p_size * 2 AS danceability, CAST(l_quantity AS INTEGER) AS valence,
         100 - p_size * 2 AS acousticness, -CAST(round(l_tax * 100) AS INTEGER) AS loudness,
         l_linenumber AS liveness, CAST(l_quantity AS INTEGER) + 120 AS length,
         l_linenumber * 3 AS speechiness, l_shipdate AS processed_at, 'historical' AS event_type
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)"""

SURGES = """
surges AS (
  SELECT CAST(e.event_id AS VARCHAR) AS event_id, 'popularity_surge' AS event_type,
         CASE WHEN e.event_id % 10 = 0 THEN NULL ELSE p_name END AS song_title, s_name AS artist,
         e.event_type AS reason, CAST(15 + e.event_id % 26 AS INTEGER) AS boost_amount,
         CAST(1 + e.user_id % 100 AS INTEGER) AS original_popularity, true AS has_timeout,
         e.ts AS created_at, p_name AS title
  FROM events e
  JOIN part ON p_partkey = e.event_id % (SELECT count(*) FROM part)
  JOIN supplier ON s_suppkey = e.user_id % (SELECT count(*) FROM supplier))"""

_EVENT_COLUMNS = (
    "event_id, event_type, song_title, artist, reason, boost_amount, original_popularity, "
    "has_timeout, created_at"
)

_SONG_COLUMNS = (
    "title, artist, genre, year, popularity, bpm, energy, danceability, valence, acousticness, "
    "loudness, liveness, length, speechiness, processed_at, event_type"
)


def _round(number: str, digits: int) -> str:
    text = f"CAST(CAST({number} AS VARCHAR) AS DECIMAL(30,15))"
    return f"CAST(round({text}, {digits}) AS DOUBLE)"


def _exact_std(number: str) -> str:
    """Sample deviation of whole numbers from their sums, free of the order of rows."""
    spread = f"count({number}) * sum({number} * {number}) - sum({number}) * sum({number})"
    pairs = f"(CAST(count({number}) AS DOUBLE) * (count({number}) - 1))"
    return f"CASE WHEN count({number}) > 1 THEN sqrt(CAST({spread} AS DOUBLE) / {pairs}) ELSE NULL END"


def _title(text: str) -> str:
    runs = f"regexp_extract_all(lower({text}), '[a-z]+|[^a-z]+')"
    return f"array_to_string(list_transform({runs}, lambda r: upper(r[1]) || r[2:]), '')"


def _one_decimal(number: str) -> str:
    return f"printf('%.1f', {_round(number, 1)})"


STRICT = (
    "genre IS NOT NULL AND title IS NOT NULL AND artist IS NOT NULL "
    "AND year BETWEEN 1900 AND {end} AND popularity BETWEEN 1 AND 100"
)
LENIENT = "genre IS NOT NULL AND year BETWEEN 1900 AND {end} AND popularity >= 1"


def _decades(length: int = 10, end: int = 2030, rule: str = LENIENT, key: str = "lower(trim(genre))") -> str:
    return f"""{SONGS},
kept AS (
  SELECT {key} AS genre, CAST(floor(year / {length}.0) * {length} AS BIGINT) AS decade, artist, year, popularity
  FROM songs WHERE {rule.format(end=end)}),
decades AS (
  SELECT genre, decade, decade + {length - 1} AS decade_end, count(*) AS songs_in_decade,
         {_round("avg(popularity)", 2)} AS avg_popularity,
         {_round(_exact_std("CAST(popularity AS HUGEINT)"), 2)} AS popularity_std,
         max(popularity) AS max_popularity, min(popularity) AS min_popularity,
         count(DISTINCT artist) AS unique_artists, count(DISTINCT year) AS years_covered
  FROM kept GROUP BY genre, decade HAVING count(*) >= 10)"""


def _summary(**options) -> str:
    return f"""{_decades(**options)},
summary AS (
  SELECT genre, count(*) AS decades_active, min(decade) AS first_decade, max(decade) AS last_decade,
         CAST(sum(songs_in_decade) AS BIGINT) AS total_songs,
         CAST(sum(unique_artists) AS BIGINT) AS total_artists,
         list_reduce(list(avg_popularity ORDER BY decade), lambda x, y: x + y) / count(*)
           AS overall_avg_popularity,
         {_round("(" + _exact_std("CAST(round(avg_popularity * 100) AS HUGEINT)") + ") / 100", 2)}
           AS decade_popularity_variance,
         max(avg_popularity) AS peak_decade_popularity, min(avg_popularity) AS lowest_decade_popularity
  FROM decades GROUP BY genre HAVING count(*) >= 2 AND sum(songs_in_decade) >= 50)"""


def _scores(day: str = "2024-01-31", name: str = "scores", **options) -> str:
    length, end = options.get("length", 10), options.get("end", 2030)
    most = float((end - 1900 + 1) // (length / 2))
    mean, spread = "overall_avg_popularity", "decade_popularity_variance"
    gap = "(peak_decade_popularity - lowest_decade_popularity)"
    presence = f"least(1e2, decades_active * 1e2 / CAST({most} AS DOUBLE))"
    consistency = (
        f"CASE WHEN {mean} > 0 AND {spread} > 0 THEN greatest(0e0, 100 - {spread} / {mean} * 300) "
        f"WHEN {spread} = 0 THEN 85e0 ELSE 0e0 END"
    )
    longevity = (
        "least(1e2, (last_decade - first_decade) / 5e1 * 60 + decades_active * 5 "
        "+ least(1e1, log10(total_songs) * 3))"
    )
    stability = f"CASE WHEN {gap} > 0 THEN greatest(0e0, 100 - {gap} / {mean} * 200) ELSE 7e1 END"
    return f"""{_summary(**options)},
parts AS (
  SELECT *, (last_decade - first_decade) / CAST({length} AS DOUBLE) + 1 AS time_span_decades,
         {_round(presence, 1)} AS decade_presence_score,
         {_round(consistency, 1)} AS consistency_score,
         {_round(longevity, 1)} AS longevity_score,
         {_round(stability, 1)} AS stability_score,
         CASE WHEN {mean} < 30 THEN 15 WHEN {mean} < 45 THEN 8 WHEN {mean} < 60 THEN 3 ELSE 0 END
           AS popularity_penalty,
         CASE WHEN last_decade < {end - 20} THEN 12 WHEN last_decade < {end - 10} THEN 6 ELSE 0 END
           AS recency_penalty,
         CASE WHEN {mean} >= 70 THEN 'high' WHEN {mean} >= 45 THEN 'medium' ELSE 'low' END
           AS popularity_tier
  FROM summary),
{name} AS (
  SELECT genre, decades_active AS decade_presence, time_span_decades, total_songs, total_artists,
         {_round(mean, 1)} AS avg_popularity, popularity_tier, decade_presence_score, consistency_score,
         longevity_score, stability_score, popularity_penalty, recency_penalty,
         {_round('''greatest(0e0, consistency_score * CAST(0.35 AS DOUBLE)
           + longevity_score * CAST(0.25 AS DOUBLE) + stability_score * CAST(0.20 AS DOUBLE)
           + CAST(CAST(decade_presence_score AS DECIMAL(5,1)) * 0.20 AS DOUBLE)
           - popularity_penalty - recency_penalty)''', 1)} AS timeless_score,
         '{day}' AS analysis_date, CAST({length} AS INTEGER) AS analysis_period_years
  FROM parts WHERE consistency_score > 0 AND longevity_score > 0 AND decades_active >= 2)"""


_LANDED = """
  SELECT genre, analysis_date, analysis_period_years, timeless_score, consistency_score,
         longevity_score, stability_score AS variance_score, decade_presence_score AS peak_stability,
         CAST(decade_presence AS INTEGER) AS decade_presence,
         CAST(trunc(time_span_decades) AS INTEGER) AS year_span,
         total_songs, total_artists AS total_unique_artists,
         CAST(NULL AS VARCHAR) AS period_stats, CAST(NULL AS VARCHAR) AS analysis_metadata
  FROM scores"""

_BEST = "ORDER BY timeless_score DESC, genre"

_TREND_GROUPS = f"""{SONGS},
windows AS (
  SELECT genre, time_bucket(INTERVAL 5 MINUTE, processed_at) AS window_start, count(*) AS song_count,
         avg(popularity) AS avg_popularity, stddev_samp(popularity) AS std_popularity,
         max(popularity) AS max_popularity, min(popularity) AS min_popularity,
         count(DISTINCT artist) AS unique_artists
  FROM songs WHERE genre IS NOT NULL GROUP BY genre, window_start),
landed AS (
  SELECT genre, {_round("avg_popularity", 2)} AS avg_popularity, song_count,
         window_start AS analysis_window, {_round("std_popularity", 2)} AS std_popularity,
         max_popularity, min_popularity, unique_artists
  FROM windows)"""

_LEADERS = """
leaders AS (
  SELECT genre, count(*) AS song_count FROM songs WHERE genre IS NOT NULL
  GROUP BY genre ORDER BY song_count DESC, genre LIMIT 5)"""

_FEATURES = f"""{SONGS},{_LEADERS},
features AS (
  SELECT genre, avg(energy) AS energy, avg(danceability) AS danceability, avg(valence) AS valence,
         avg(acousticness) AS acousticness
  FROM songs WHERE genre IN (SELECT genre FROM leaders) GROUP BY genre)"""

_ATTRIBUTES = {
    "artist": "artist", "top_genre": "genre", "bpm": "bpm", "energy": "energy",
    "danceability": "danceability", "loudness": "loudness", "liveness": "liveness",
    "valence": "valence", "length": "length", "acousticness": "acousticness",
    "speechiness": "speechiness",
}

_SUMS = (
    f"{SONGS},\nsums AS (\n  "
    + "\n  UNION ALL ".join(
        f"SELECT '{name}' AS attribute, year, CAST({column} AS VARCHAR) AS value, "
        f"CAST(sum(popularity) AS BIGINT) AS total FROM songs GROUP BY year, {column}"
        for name, column in _ATTRIBUTES.items()
    )
    + """),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY attribute, year
                               ORDER BY total DESC, value NULLS FIRST) AS rank FROM sums)"""
)

_JOINED = f"""{SONGS},{SURGES},
known AS (SELECT DISTINCT title AS t, artist AS a, genre, year FROM songs),
joined AS (
  SELECT e.event_id, e.event_type, e.song_title, e.artist, e.reason, e.boost_amount, e.created_at,
         coalesce(k.genre, 'Unknown') AS genre, k.year
  FROM {{events}} e LEFT JOIN known k
    ON e.song_title IS NOT DISTINCT FROM k.t AND e.artist IS NOT DISTINCT FROM k.a)"""

_NEWEST_FIRST = "ORDER BY created_at DESC NULLS LAST, event_id DESC NULLS LAST, year DESC NULLS LAST"


def _list(text: str, name: str) -> str:
    return f"string_agg({text}, '|' {_NEWEST_FIRST}) AS {name}_list"


_LINE = """'• ' || coalesce(song_title, 'Unknown') || ' - ' || coalesce(artist, 'Unknown')
         || ' (' || coalesce(CAST(year AS VARCHAR), 'Unknown') || ')' || chr(10) || '  Event: '
         || event_type || ' (' || reason || ') [+' || boost_amount || ']'"""

# Raw cells as the adapter spells them: a number by its line, then the policies.
_RAW = f"""{SONGS},
raw AS (
  SELECT liveness AS line, genre AS top_genre,
         CASE WHEN liveness = 6 THEN '' ELSE title END AS title,
         CASE WHEN liveness = 5 THEN NULL ELSE artist END AS artist,
         CASE WHEN liveness = 7 THEN NULL ELSE year END AS year, bpm,
         CASE WHEN liveness = 4 THEN NULL ELSE energy END AS energy,
         danceability, loudness, liveness, valence,
         CASE WHEN liveness = 3 THEN NULL ELSE length END AS length,
         acousticness, speechiness, popularity
  FROM songs)"""

_CLEAN_SELECT = """
SELECT CASE WHEN title = '' THEN 'Unknown' ELSE title END AS title, artist, trim(top_genre) AS top_genre,
       coalesce(year, 2000) AS year, bpm, coalesce(energy, 50) AS energy, danceability, loudness,
       liveness, valence, coalesce(length, 180000) AS length, acousticness, speechiness, popularity
FROM raw WHERE line <> 5"""


def _iso(moment: str) -> str:
    return (
        f"CASE WHEN microsecond({moment}) % 1000000 = 0 THEN strftime({moment}, '%Y-%m-%dT%H:%M:%S') "
        f"ELSE strftime({moment}, '%Y-%m-%dT%H:%M:%S.%f') END"
    )


_MESSAGE_FIELDS = (
    "title", "artist", "top_genre", "year", "bpm", "energy", "danceability", "loudness",
    "liveness", "valence", "length", "acousticness", "speechiness", "popularity",
)


def _message() -> str:
    fields = []
    for name in _MESSAGE_FIELDS:
        column = {"top_genre": "genre"}.get(name, name)
        quote = '"' if name in ("title", "artist", "top_genre") else ""
        fields.append(f"""'"{name}":{quote}' || {column} || '{quote}'""")
    song = " || ',' || ".join(fields)
    sent = _iso("processed_at")
    return (
        f"""'{{"event_type":"historical","timestamp":"' || {sent} || '","song_data":{{' || {song} """
        f"""|| '}},"metadata":{{"processing_time":"' || {sent} || '","source":"song_catalog"}}}}'"""
    )


def _landed_event(event_type, title, event_id, boost, reason, original, timeout, created) -> str:
    return f"""
  SELECT '{event_type}' AS event_type, {title} AS song_title, artist,
         '{{"event_id":"' || {event_id} || '","boost_amount":' || {boost} || ',"reason":"' || {reason}
         || '","original_popularity":' || {original} || ',"has_timeout":{timeout}}}' AS metadata,
         {created} AS created_at, {event_id} AS event_id, {boost} AS boost_amount, {reason} AS reason,
         CAST({original} AS INTEGER) AS original_popularity, {timeout} AS has_timeout
  FROM surges"""


_LANDED_SURGES = _landed_event(
    "popularity_surge", "title", "event_id", "boost_amount", "reason", "original_popularity", "true",
    "created_at",
)
_LANDED_ROLLBACKS = _landed_event(
    "timeout_rollback", "title", "event_id", "boost_amount", "'timeout_expired'", "0", "false",
    "created_at + INTERVAL 30 SECOND",
)

_ROLLBACKS = """
SELECT 'timeout_rollback' AS event_type, event_id AS original_event_id,
       'timeout_' || event_id AS message_key, song_title, artist,
       original_popularity AS popularity, boost_amount AS original_boost,
       'timeout_expired' AS rollback_reason, CAST(30 AS INTEGER) AS duration_seconds,
       created_at + INTERVAL 30 SECOND AS created_at
FROM surges"""


_LANDED_SONGS = """
SELECT title, artist, genre, year, popularity, energy, danceability, valence, acousticness, bpm, length,
       processed_at, event_type, processed_at AS source_timestamp
FROM songs"""

_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def _with_decade(rule: str) -> str:
    return f"""WITH {SONGS}
SELECT {_SONG_COLUMNS}, CAST(floor(year / 10.0) * 10 AS BIGINT) AS decade,
       CAST(floor(year / 10.0) * 10 AS BIGINT) || 's' AS decade_label
FROM songs WHERE {rule.format(end=2030)}"""


def _timeline(k: int) -> str:
    return f"""{_scores()},
best AS (SELECT lower(trim(genre)) AS key FROM scores {_BEST} LIMIT {k}),
timeline AS (
  SELECT s.genre, CAST(floor(year / 5.0) * 5 AS INTEGER) AS period_start, count(*) AS song_count,
         {_round("avg(popularity)", 1)} AS avg_popularity,
         {_round("stddev_samp(popularity)", 1)} AS popularity_std,
         max(popularity) AS max_popularity, min(popularity) AS min_popularity,
         count(DISTINCT artist) AS unique_artists
  FROM songs s JOIN best ON lower(trim(s.genre)) = key
  WHERE year BETWEEN 1980 AND 2024 GROUP BY s.genre, period_start HAVING count(*) >= 3),
labelled AS (
  SELECT *, period_start + 4 AS period_end, period_start || '-' || (period_start + 4) AS period_label
  FROM timeline)"""


_ORACLE = {
    "clean_songs": f"WITH {_RAW}{_CLEAN_SELECT}",
    "replayable_songs": f"WITH {_RAW}{_CLEAN_SELECT} AND year IS NOT NULL",
    "clean_songs_drop_policy": f"""WITH {_RAW}
SELECT title, coalesce(artist, '') AS artist, trim(top_genre) AS top_genre, line AS index, year, bpm, energy,
       danceability, loudness, liveness, valence, length, acousticness, speechiness, popularity
FROM raw WHERE line IN (1, 5, 6)""",
    "strict_filter": _with_decade(STRICT),
    "lenient_filter": _with_decade(LENIENT),
    "decade_stats": f"WITH {_decades()} SELECT * FROM decades",
    "genre_summary": f"WITH {_summary()} SELECT * FROM summary",
    "genre_decade_list": f"""WITH {_summary(length=2, end=2003)}
SELECT genre, CAST(count(*) AS INTEGER) AS decade_count,
       string_agg(printf('%d:%.2f:%d', decade, avg_popularity, songs_in_decade), ';' ORDER BY decade)
         AS decade_text
FROM decades WHERE genre IN (SELECT genre FROM summary) GROUP BY genre""",
    "timeless_scores": f"WITH {_scores()} SELECT * FROM scores",
    "timeless_scores_2y": f"WITH {_scores(length=2, end=2003)} SELECT * FROM scores",
    "timeless_scores_strict": f"WITH {_scores(rule=STRICT, key='genre')} SELECT * FROM scores",
    "score_landing": f"WITH {_scores()} {_LANDED}",
    "stream_rescoring": f"WITH {_scores()} {_LANDED}",
    "score_summary": f"""WITH {_scores()}
SELECT count(*) AS total_analyzed, max(timeless_score) AS max_score,
       CAST(sum(CAST(timeless_score AS DECIMAL(5,1))) AS DOUBLE) / count(*) AS avg_score
FROM scores""",
    "ranked_snapshot": f"""WITH {_scores()}, landed AS ({_LANDED})
SELECT *, row_number() OVER ({_BEST}) AS ranking FROM landed""",
    "champion": f"""WITH {_scores()}
SELECT genre, {_title("genre")} AS genre_title, {_one_decimal("timeless_score")} || '/100' AS score_text
FROM scores {_BEST} LIMIT 1""",
    "top_rankings": f"""WITH {_scores()}
SELECT genre, timeless_score, {_one_decimal("timeless_score")} AS score_text,
       CAST(row_number() OVER ({_BEST}) AS INTEGER) AS ranking
FROM scores {_BEST} LIMIT 10""",
    "summary_table": f"""WITH {_scores()}
SELECT CAST(row_number() OVER ({_BEST}) AS INTEGER) AS ranking, {_title("genre")} AS genre_title,
       {_one_decimal("timeless_score")} AS timeless_score_text,
       {_one_decimal("consistency_score")} AS consistency_score_text,
       {_one_decimal("longevity_score")} AS longevity_score_text,
       CAST(decade_presence AS INTEGER) AS decade_presence
FROM scores {_BEST} LIMIT 6""",
    "picker_options": f"""WITH {_scores()}
SELECT {_title("genre")} || ' (Score: ' || {_one_decimal("timeless_score")} || ')' AS label, genre AS value
FROM scores {_BEST} LIMIT 10""",
    "score_components_long": f"""WITH {_scores()}, best AS (SELECT * FROM scores {_BEST} LIMIT 5)
SELECT genre, 'timeless_score' AS metric, timeless_score AS score FROM best
UNION ALL SELECT genre, 'consistency_score', consistency_score FROM best
UNION ALL SELECT genre, 'longevity_score', longevity_score FROM best""",
    "score_histogram": f"""WITH {_scores()},
bounds AS (SELECT min(timeless_score) AS low, max(timeless_score) AS high FROM scores),
binned AS (
  SELECT CASE WHEN high = low THEN 1
              ELSE least(floor((timeless_score - low) * 15 / (high - low)) + 1, 15) END AS bin
  FROM scores, bounds),
bins AS (
  SELECT CAST(unnest(generate_series(1, CASE WHEN low = high THEN 1 ELSE 15 END)) AS INTEGER) AS bin,
         low, high FROM bounds)
SELECT b.bin, low + (high - low) / 15 * (b.bin - 1) AS bin_start, low + (high - low) / 15 * b.bin AS bin_end,
       (SELECT count(*) FROM binned x WHERE x.bin = b.bin) AS genre_count,
       (SELECT CAST(sum(CAST(timeless_score AS DECIMAL(5,1))) AS DOUBLE) / count(*) FROM scores) AS mean_score
FROM bins b""",
    "genre_breakdown": f"""WITH {SONGS}
SELECT CAST(floor(year / 10.0) * 10 AS BIGINT) AS decade,
       CAST(floor(year / 10.0) * 10 AS BIGINT) || 's' AS decade_label, count(*) AS songs,
       {_round("avg(popularity)", 1)} AS avg_pop, count(DISTINCT artist) AS artists,
       min(year) AS first_year, max(year) AS last_year
FROM songs WHERE {STRICT.format(end=2030)} AND genre = 'Brand#12' GROUP BY ALL""",
    "genre_timeline": f"WITH {_timeline(10)} SELECT * FROM labelled",
    "timeline_of_genre": f"""WITH {_timeline(25)}
SELECT *, {_title("'brand#16'")} || ' - Timeless Journey (Score: '
       || printf('%.1f', coalesce((SELECT timeless_score FROM scores WHERE lower(genre) = 'brand#16'), 0))
       || '/100)' AS heading
FROM labelled WHERE lower(genre) = 'brand#16'""",
    "genre_window_trends": f"""WITH {_TREND_GROUPS}
SELECT genre, window_start, window_start + INTERVAL 5 MINUTE AS window_end, song_count, avg_popularity,
       {_round("std_popularity", 6)} AS std_popularity, max_popularity, min_popularity, unique_artists
FROM windows""",
    "trend_landing": f"WITH {_TREND_GROUPS} SELECT * FROM landed",
    "recent_trends": f"""WITH {_TREND_GROUPS}
SELECT * FROM landed ORDER BY analysis_window DESC, genre, avg_popularity, song_count LIMIT 1000""",
    "stream_genre_trends": f"WITH {_TREND_GROUPS} SELECT * EXCLUDE (unique_artists), true AS artists_close FROM landed",
    "stream_trend_updates": f"WITH {_TREND_GROUPS} SELECT * EXCLUDE (unique_artists), true AS artists_close FROM landed",
    "trend_rollup": f"""WITH {_TREND_GROUPS}
SELECT genre, CAST(sum(CAST(avg_popularity AS DECIMAL(12,2))) AS DOUBLE) / count(*) AS avg_popularity,
       CAST(sum(song_count) AS BIGINT) AS song_count
FROM landed GROUP BY genre ORDER BY avg_popularity DESC, genre LIMIT 10""",
    "popularity_10min": f"""WITH {SONGS},{_LEADERS}
SELECT time_bucket(INTERVAL 10 MINUTE, processed_at) AS time_bucket, genre, avg(popularity) AS popularity
FROM songs WHERE genre IN (SELECT genre FROM leaders) GROUP BY 1, 2""",
    "audio_features": f"WITH {_FEATURES} SELECT * FROM features",
    "audio_features_long": f"""WITH {_FEATURES}
UNPIVOT (SELECT * FROM features) ON energy, danceability, valence, acousticness
INTO NAME feature VALUE mean_value""",
    "top_genres_by_rows": f"WITH {SONGS},{_LEADERS} SELECT * FROM leaders",
    "catalog_totals": f"""WITH {_scores()}
SELECT count(*) AS total_songs, count(DISTINCT genre) AS total_genres, count(DISTINCT artist) AS total_artists,
       (SELECT count(*) FROM scores) AS timeless_analyses
FROM songs""",
    "year_range": f"""WITH {SONGS}
SELECT count(*) AS total_songs, count(DISTINCT genre) AS unique_genres, min(year) AS first_year,
       max(year) AS last_year
FROM songs WHERE {STRICT.format(end=2030)}""",
    "table_counts": "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _TABLES
    ),
    "smoke_group": f"""WITH {SONGS}
SELECT genre, avg(popularity) AS avg_popularity, count(*) AS song_count, max(year) AS latest_year
FROM songs GROUP BY genre""",
    "smoke_row_number": f"""WITH {SONGS}
SELECT genre, popularity, year,
       row_number() OVER (PARTITION BY genre ORDER BY popularity DESC, year DESC) AS rank
FROM songs""",
    "recent_songs": f"""WITH {SONGS}
SELECT {_SONG_COLUMNS} FROM songs
ORDER BY processed_at DESC, title, artist, genre, year, popularity, bpm, energy, danceability, valence,
         acousticness, loudness, liveness, length, speechiness LIMIT 10000""",
    "recent_events": f"""WITH {SURGES}
SELECT {_EVENT_COLUMNS} FROM surges ORDER BY created_at DESC, event_id LIMIT 1000""",
    "attribute_year_sums": f"WITH {_SUMS} SELECT * FROM sums",
    "attribute_year_totals": f"""WITH {_SUMS}
SELECT attribute, year, CAST(sum(total) AS BIGINT) AS total FROM sums GROUP BY attribute, year""",
    "attribute_top10": f"""WITH {_SUMS}
SELECT attribute, year, value, total, CAST(rank AS INTEGER) AS rank
FROM placed WHERE rank <= 10 AND year % 5 = 0""",
    "attribute_heatmap": f"""WITH {_SUMS},
cells AS (SELECT * FROM placed WHERE rank <= 15),
shown AS (SELECT DISTINCT attribute, value FROM cells),
enough AS (SELECT attribute FROM shown GROUP BY attribute HAVING count(*) >= 2),
grid AS (
  SELECT attribute, value, y.year FROM shown JOIN enough USING (attribute),
         (SELECT DISTINCT year FROM songs) y)
SELECT g.attribute, g.value, g.year, coalesce(c.total, 0) AS total
FROM grid g LEFT JOIN cells c
  ON c.attribute = g.attribute AND c.value IS NOT DISTINCT FROM g.value AND c.year = g.year""",
    "event_type_counts": f"""WITH {SURGES}
SELECT 'popularity_surge' AS event_type, count(*) AS event_count FROM surges
UNION ALL SELECT 'timeout_rollback', count(*) FROM surges""",
    "events_by_genre": f"""WITH {_JOINED.format(events="surges")},
counted AS (SELECT genre, count(*) AS event_count FROM joined GROUP BY genre),
listed AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY genre {_NEWEST_FIRST}) AS place FROM joined)
  WHERE place <= 1000)
SELECT genre, {_list("event_type", "event_type")}, {_list("coalesce(song_title, '')", "song_title")},
       {_list("coalesce(artist, '')", "artist")}, {_list("coalesce(CAST(year AS VARCHAR), '')", "year")},
       {_list("reason", "reason")}, {_list("CAST(boost_amount AS VARCHAR)", "boost_amount")},
       {_list("strftime(created_at, '%Y-%m-%d %H:%M:%S.%f')", "created_at")}, any_value(event_count) AS event_count
FROM listed JOIN counted USING (genre) GROUP BY genre""",
    "event_counts_by_genre": f"""WITH {_JOINED.format(events="surges")}
SELECT genre, count(*) AS event_count FROM joined GROUP BY genre""",
    "event_details": f"""WITH {_JOINED.format(events="surges")},
placed AS (SELECT *, row_number() OVER (PARTITION BY genre {_NEWEST_FIRST}) AS place FROM joined),
counted AS (SELECT genre, count(*) AS event_count FROM joined GROUP BY genre),
lines AS (
  SELECT genre, string_agg({_LINE}, chr(10) ORDER BY place) AS text FROM placed WHERE place <= 5 GROUP BY genre)
SELECT genre, {_title("genre")} AS genre_title, event_count,
       {_title("genre")} || chr(10) || 'Total Events: ' || event_count || chr(10) || chr(10) || text
       || CASE WHEN event_count > 5 THEN chr(10) || '... and ' || (event_count - 5) || ' more' ELSE '' END
         AS detail_text
FROM counted JOIN lines USING (genre)""",
    "song_messages": f"""WITH {SONGS}
SELECT artist || '_' || title AS key, {_message()} AS value FROM songs""",
    "song_json_flatten": f"WITH {SONGS}{_LANDED_SONGS}",
    "stream_song_landing": f"WITH {SONGS}{_LANDED_SONGS}",
    "event_json_flatten": f"WITH {SURGES}{_LANDED_SURGES}\n  UNION ALL{_LANDED_ROLLBACKS}",
    "stream_event_landing": f"WITH {SURGES}{_LANDED_SURGES}",
    "surge_boost": f"""WITH {SURGES}
SELECT {_EVENT_COLUMNS}, least(100, original_popularity + boost_amount) AS new_popularity,
       created_at + INTERVAL 30 SECOND AS expire_time, CAST(30 AS INTEGER) AS timeout_duration
FROM surges""",
    "surge_rollbacks": f"WITH {SURGES}{_ROLLBACKS}",
    "stream_surge_expiry": f"WITH {SURGES}{_ROLLBACKS}",
    "stream_surge_timers": f"WITH {SURGES}{_ROLLBACKS}",
    "stream_matched_rollbacks": f"""WITH {SURGES},
ended AS (
  SELECT event_id AS ended_id, boost_amount AS original_boost,
         created_at + INTERVAL 30 SECOND
           + CASE WHEN CAST(event_id AS BIGINT) % 11 = 0 THEN INTERVAL 120 SECOND ELSE INTERVAL 0 SECOND END AS rolled_back_at
  FROM surges WHERE CAST(event_id AS BIGINT) % 7 <> 0)
SELECT event_id, reason, boost_amount, created_at, rolled_back_at, original_boost
FROM surges LEFT JOIN ended ON ended_id = event_id
  AND rolled_back_at BETWEEN created_at AND created_at + INTERVAL 60 SECOND""",
    "surges_and_rollbacks": f"""WITH {SURGES}
SELECT event_type, event_id, CAST(NULL AS VARCHAR) AS original_event_id, boost_amount, created_at FROM surges
UNION ALL
SELECT 'timeout_rollback', NULL, event_id, NULL, created_at + INTERVAL 30 SECOND FROM surges""",
    "matched_rollbacks": f"""WITH {SURGES}
SELECT event_id, created_at, created_at + INTERVAL 30 SECOND AS rolled_back_at, boost_amount AS original_boost
FROM surges""",
}


# Songs with gaps and values on the limits: the same SQL over another table of songs.
_EDGES = (
    SONGS.replace("songs AS", "plain AS", 1)
    + """,
marked AS (
  SELECT *, CAST(substr(trim(genre), 7) AS INTEGER) AS n, year - 1995 AS step,
         (valence * 31 + danceability * 7 + energy + liveness) % 97 AS mark
  FROM plain),
spanned AS (
  SELECT *, CASE n % 5 WHEN 0 THEN 1960 + step * 5 WHEN 1 THEN 1985 + step * 5 WHEN 2 THEN 1990 + step * 5
                       WHEN 3 THEN 1970 + step ELSE 1900 + step * 20 END AS span
  FROM marked),
songs AS (
  SELECT CASE WHEN mark <> 1 THEN title END AS title, CASE WHEN mark <> 2 THEN artist END AS artist,
         CASE WHEN mark <> 0 THEN genre END AS genre,
         CAST(CASE WHEN mark = 8 THEN 1899 WHEN mark = 9 AND n % 5 = 4 THEN 1900
                   WHEN mark = 10 AND n % 5 = 4 THEN 2030 WHEN mark = 11 THEN 2031
                   WHEN mark <> 12 THEN span END AS INTEGER) AS year,
         CAST(CASE WHEN mark = 3 THEN 0 WHEN mark = 4 THEN 1 WHEN mark = 5 THEN 100 WHEN mark = 6 THEN 101
                   WHEN mark = 7 THEN NULL WHEN n = 7 AND span < 2000 THEN 5 WHEN n = 7 THEN 95
                   ELSE least(100, 1 + popularity * ((n // 5) % 5 + 1) * 2 // 5) END AS INTEGER) AS popularity,
         bpm, energy, danceability, valence, acousticness, loudness, liveness, length,
         CAST(3 AS INTEGER) AS speechiness, processed_at, event_type
  FROM spanned
  UNION ALL
  SELECT p_name, 'edge artist ' || (p_partkey % 7),
         CASE WHEN p_partkey < 59 THEN 'edge a' WHEN p_partkey < 108 THEN 'edge b' ELSE 'edge c' END,
         CASE WHEN p_partkey < 9 OR p_partkey BETWEEN 59 AND 68 THEN 1990
              WHEN p_partkey < 59 THEN 1970 + p_partkey % 2 * 10 WHEN p_partkey < 108 THEN 1980
              WHEN p_partkey < 168 THEN 1980 + p_partkey % 2 * 10 ELSE 2015 END,
         CASE WHEN p_partkey < 108 THEN 50 + p_partkey % 20 ELSE 50 END,
         120, 50, 50, 50, 50, -5, 1, 200, 3, TIMESTAMP '2020-01-01', 'historical'
  FROM part WHERE p_partkey < 170)"""
)

for _name in (
    "strict_filter", "lenient_filter", "decade_stats", "genre_summary", "timeless_scores",
    "timeless_scores_strict", "trend_landing",
):
    _ORACLE[f"{_name}_edges"] = _ORACLE[_name].replace(SONGS, _EDGES)
_ORACLE["genre_timeline_edges"] = f"WITH {_timeline(1_000)} SELECT * FROM labelled".replace(SONGS, _EDGES)
_ORACLE["attribute_heatmap_edges"] = _ORACLE["attribute_heatmap"].replace(
    SONGS, _EDGES.replace("songs AS", "edge_songs AS", 1)
    + f",\nsongs AS (SELECT * FROM edge_songs WHERE {LENIENT.format(end=2030)})"
)

_ORACLE["song_file_scan"] = _ORACLE["clean_songs"]
_ORACLE["song_file_split_scan"] = _ORACLE["clean_songs"]
_ORACLE["songs_in_year_order"] = f"""WITH {_RAW}
SELECT CAST(coalesce(year, 9999) AS INTEGER) AS year, count(*) AS song_count, true AS in_order
FROM raw WHERE line <> 5 GROUP BY 1"""
_ORACLE["attribute_sums_in_order"] = f"""WITH {_SUMS}
SELECT attribute, year, count(*) AS value_count, true AS in_order FROM sums GROUP BY attribute, year"""
_ORACLE["view_counts"] = f"""WITH {SONGS},{SURGES}
SELECT artist, count(*) AS song_count,
       (SELECT count(*) FROM surges WHERE surges.artist = songs.artist) AS event_count
FROM songs GROUP BY artist"""
_ORACLE["landing_table_counts"] = f"""WITH {SONGS},{SURGES}
SELECT 'song_analytics' AS table_name, count(*) AS row_count FROM songs
UNION ALL SELECT 'real_time_events', count(*) FROM surges
UNION ALL SELECT unnest(['genre_trends', 'timeless_genre_metrics', 'emptied song_analytics',
  'emptied genre_trends', 'emptied real_time_events', 'emptied timeless_genre_metrics']), 0"""
_ORACLE["minimum_data_gate"] = f"""WITH {_EDGES}
SELECT genre, count(*) >= 50 AS enough, count(*) AS song_count
FROM songs WHERE genre IN ('edge a', 'edge b') GROUP BY genre"""
_ORACLE["new_event_ids"] = f"""WITH {SONGS}
SELECT count(*) AS song_count, count(*) AS id_count, CAST(36 AS INTEGER) AS id_length FROM songs"""
_ORACLE["stamped_events"] = f"""WITH {SURGES}
SELECT 'popularity_surge' AS event_type, count(*) AS event_count, count(*) AS id_count,
       CAST(sum(boost_amount) AS BIGINT) AS boost, true AS stamped FROM surges
UNION ALL SELECT 'timeout_rollback', count(*), 0, NULL, true FROM surges"""

_ORACLE["replay_order"] = f"""WITH {_RAW}, sent AS ({_CLEAN_SELECT} AND year IS NOT NULL)
SELECT year, count(*) AS message_count, true AS in_order, true AS split FROM sent GROUP BY year"""
_ORACLE["stream_progress_log"] = f"""WITH {SURGES}
SELECT 'events' AS name, CAST(8 AS BIGINT) AS batches, count(*) AS input_rows, true AS all_landed, true AS ended,
       false AS failed, false AS failure_noted FROM surges
UNION ALL SELECT 'songs', 3, NULL, true, true, true, true"""

_ORACLE["report_totals"] = _ORACLE["catalog_totals"]
_ORACLE["report_event_details"] = _ORACLE["event_details"]
_ORACLE["report_trend_rollup"] = _ORACLE["trend_rollup"]


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)
