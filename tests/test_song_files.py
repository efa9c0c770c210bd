import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from perennial.operators import cleaning
from perennial.plans.replay_job import in_year_order, replay_messages, write_replay
from perennial.schemas import NUMBER_DEFAULTS, SONG_FILE_COLUMNS
from perennial.sources.song_files import read_song_files, table_from_rows

HEADER = ",".join(SONG_FILE_COLUMNS)
LINES = [
    '1,Sunrise,Lake Choir,adult standards,2004,157,30,53,-14,11,68,201,94,3,71',
    '2,"Hello, Goodbye",  The Band ,Album Rock,1967,100,50,50,-8,10,50,"1,412",20,5,60',
    '3,Fraction,Artist,rock,1990,120,50,50,-6.9,10,50,12.7,20,5,60',
    '4,Missing,,rock,1990,120,50,50,-6,10,50,200,20,5,60',
    '5,Not There,Artist,NA,1990,120,50,50,-6,10,50,200,20,5,60',
    '6,No Year,Artist,rock,soon,120,50,50,-6,10,50,200,20,5,60',
    '7,Short,Artist,rock,1990,120',
    '8,"   ",Artist,rock,1991,120,50,50,-6,10,50,200,20,5,60',
]


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "b.csv").write_text("\n".join([HEADER, *LINES]) + "\n")
    (tmp_path / "notes.txt").write_text("not a song file\n")
    return str(tmp_path)


def by_title(df):
    return {r["title"]: r for r in df.collect()}


def test_default_policy(spark, folder):
    songs = by_title(cleaning.clean_songs(read_song_files(spark, folder)))
    assert set(songs) == {"Sunrise", "Hello, Goodbye", "Fraction", "No Year", "Unknown"}
    assert songs["Sunrise"]["loudness"] == -14
    assert songs["Hello, Goodbye"]["length"] == 180000
    assert songs["Hello, Goodbye"]["artist"] == "The Band"
    assert (songs["Fraction"]["length"], songs["Fraction"]["loudness"]) == (12, -6)
    assert songs["No Year"]["year"] == 2000
    assert all(songs["Sunrise"][c] is not None for c in NUMBER_DEFAULTS)


def test_drop_policy(spark, folder):
    songs = by_title(cleaning.clean_songs_or_drop(read_song_files(spark, folder)))
    assert set(songs) == {"Sunrise", "Missing", "Not There", ""}
    assert songs["Missing"]["artist"] == ""
    assert songs["Not There"]["top_genre"] == "NA"


def test_unread_years_are_not_replayed(spark, folder):
    prepared = cleaning.prepare_songs(read_song_files(spark, folder))
    titles = {r["title"] for r in cleaning.replayable_songs(prepared).collect()}
    assert "No Year" not in titles and "Sunrise" in titles


def test_order_by_year_puts_unread_years_last(spark, folder):
    years = [r["year"] for r in cleaning.prepare_songs(read_song_files(spark, folder), ordered=True).collect()]
    assert years[-1] is None and years[:-1] == sorted(years[:-1])


def test_first_file_only(spark, folder):
    with open(os.path.join(folder, "a.csv"), "w") as f:
        f.write(HEADER + "\n" + LINES[0].replace("Sunrise", "From A") + "\n")
    assert read_song_files(spark, folder).count() == len(LINES) + 1
    first = read_song_files(spark, folder, first_only=True)
    assert [r["Title"] for r in first.collect()] == ["From A"]


def test_quoted_line_break(spark, tmp_path):
    (tmp_path / "m.csv").write_text(HEADER + "\n" + LINES[0].replace("Sunrise", '"Two\nLines"') + "\n")
    raw = read_song_files(spark, str(tmp_path))
    assert [r["Title"] for r in raw.collect()] == ["Two\nLines"]


def test_columns_are_found_by_name(spark, tmp_path):
    names = list(SONG_FILE_COLUMNS)
    swapped = ["Artist", "More", *(n for n in names if n != "Artist")]
    cells = dict(zip(names, LINES[0].split(","), strict=True)) | {"More": "x"}
    (tmp_path / "s.csv").write_text(",".join(swapped) + "\n" + ",".join(cells[n] for n in swapped) + "\n")
    row = read_song_files(spark, str(tmp_path)).first()
    assert list(row.asDict()) == names and (row["Title"], row["Artist"]) == ("Sunrise", "Lake Choir")


def test_missing_columns_and_other_headers_fail(spark, folder, tmp_path):
    with open(os.path.join(folder, "c.csv"), "w") as f:
        f.write(HEADER.replace("Title,Artist", "Artist,Title") + "\n" + LINES[0] + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_song_files(spark, folder).collect()
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "m.csv").write_text("Title,Artist\na,b\n")
    with pytest.raises(ValueError, match="Popularity"):
        read_song_files(spark, str(tmp_path / "sub"))


def test_replay_by_year(spark, folder, root):
    target = os.path.join(root, "replay")
    write_replay(replay_messages(read_song_files(spark, os.path.join(folder, "b.csv"))), target)
    years = sorted(d for d in os.listdir(target) if d.startswith("year="))
    assert years == ["year=1967", "year=1990", "year=1991", "year=2004"]
    keys = {r["key"] for r in spark.read.json(target).select("key").collect()}
    assert "Lake Choir_Sunrise" in keys


def test_messages_in_year_order_split_hot_years(spark):
    # Two thirds of the messages are of one year and alike.
    rows = [("k", "same", 1990)] * 4000 + [(f"k{i}", f"v{i}", 1970 + i % 40) for i in range(2000)]
    messages = spark.createDataFrame(rows, "key string, value string, year int").repartition(5)
    ordered = in_year_order(messages, rows_per_task=500)
    placed = ordered.select("*", F.spark_partition_id().alias("task")).collect()
    assert sorted((r.key, r.value, r.year) for r in placed) == sorted(rows)
    years = [r.year for r in placed]
    assert years == sorted(years)
    sizes = Counter(r.task for r in placed)
    assert len(sizes) > 8 and max(sizes.values()) <= 1000


def test_an_empty_replay(spark):
    assert in_year_order(spark.createDataFrame([], "key string, value string, year int")).collect() == []


def test_in_memory_table(spark):
    rows = [("Blue", "Joni", "folk", 1971, 80), ("Kind", "Miles", "jazz", 1959, 85)]
    df = table_from_rows(spark, rows, ["title", "artist", "genre", "year", "popularity"])
    assert dict(df.dtypes)["year"] == "bigint" and df.count() == 2
