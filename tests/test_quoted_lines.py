"""Files read in parts, held against the reader that reads each in one task."""

import random

import pytest
from pyspark.errors import PySparkException

from perennial.operators import cleaning
from perennial.plans import queries
from perennial.schemas import SONG_FILE_COLUMNS
from perennial.session import scratch_dir
from perennial.sources.quoted_lines import _lines, quoted_records
from perennial.sources.song_files import read_song_files

PART_BYTES = "spark.sql.files.maxPartitionBytes"
OPEN_COST = "spark.sql.files.openCostInBytes"


@pytest.fixture
def small_parts(spark):
    before = {key: spark.conf.get(key) for key in (PART_BYTES, OPEN_COST)}
    spark.conf.set(PART_BYTES, "700")
    spark.conf.set(OPEN_COST, "1")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def cell(draw):
    parts = ["a", "é", " ", ",", '"', "\n", "\n\n", "word", "\t", "long " * 60]
    text = "".join(draw.choices(parts, weights=[8, 2, 4, 2, 2, 2, 1, 8, 1, 1], k=draw.randint(1, 6)))
    quoted = any(c in text for c in ',"\n') or draw.random() < 0.2
    return '"' + text.replace('"', '""') + '"' if quoted else text


def song_file(seed, rows, header):
    draw = random.Random(seed)
    lines = [",".join(header)]
    lines += [",".join([str(k), *(cell(draw) for _ in header[1:])]) for k in range(rows)]
    lines += ["7,short", ""]
    return "\n".join(lines) + "\n"


def test_parts_give_the_records_of_whole_files(spark, tmp_path, small_parts):
    header = [*SONG_FILE_COLUMNS, "Note"]
    for seed in (1, 2, 3):
        (tmp_path / f"{seed}.csv").write_text(song_file(seed, 40, header), encoding="utf-8")
    (tmp_path / "notes.txt").write_text('an odd " quote\n')
    split = read_song_files(spark, str(tmp_path), split=True)
    whole = read_song_files(spark, str(tmp_path))
    assert split.columns == whole.columns
    assert sorted(map(repr, split.collect())) == sorted(map(repr, whole.collect()))
    assert whole.count() == 3 * 41


def test_one_file_is_many_tasks(spark, tmp_path, small_parts):
    file = tmp_path / "one.csv"
    file.write_text(song_file(9, 60, list(SONG_FILE_COLUMNS)), encoding="utf-8")
    parts = [r["part"] for r in _lines(spark, str(file), ".csv").select("part").distinct().collect()]
    assert len(parts) >= 8
    records = quoted_records(spark, str(file)).collect()
    assert sorted(r["number"] for r in records) == list(range(1, len(records) + 1))
    found = read_song_files(spark, str(file), split=True)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, read_song_files(spark, str(file)).collect()))


def test_one_cell_over_many_parts(spark, tmp_path, small_parts):
    text = '"' + "\n".join(f"line {k}" for k in range(800)) + '"'
    rest = "," * (len(SONG_FILE_COLUMNS) - 2)
    (tmp_path / "a.csv").write_text(",".join(SONG_FILE_COLUMNS) + f"\n1,{text}{rest}\n2,x{rest}\n")
    found = read_song_files(spark, str(tmp_path), split=True)
    titles = sorted(r[1] for r in found.collect())
    assert titles == ["\n".join(f"line {k}" for k in range(800)), "x"]


def test_headers_have_to_agree(spark, tmp_path):
    (tmp_path / "a.csv").write_text(",".join(SONG_FILE_COLUMNS) + "\n")
    (tmp_path / "b.csv").write_text(",".join(reversed(list(SONG_FILE_COLUMNS))) + "\n")
    with pytest.raises((ValueError, PySparkException)):
        read_song_files(spark, str(tmp_path), split=True).collect()
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "d.csv").write_text(",".join(SONG_FILE_COLUMNS) + "\n")
    assert read_song_files(spark, str(tmp_path / "c"), split=True).collect() == []


def test_records_over_batches_and_parts(spark, tmp_path, small_parts):
    """Batches of a few lines, so that records begin and end in the middle of one."""
    header = [*SONG_FILE_COLUMNS, "Note"]
    for seed in (4, 5):
        (tmp_path / f"{seed}.csv").write_text(song_file(seed, 60, header), encoding="utf-8")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        split = read_song_files(spark, str(tmp_path), split=True).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted(map(repr, split)) == sorted(map(repr, read_song_files(spark, str(tmp_path)).collect()))


def test_records_are_parsed_once_and_lines_stay_where_they_are_read(spark, tmp_path, capsys):
    (tmp_path / "one.csv").write_text(song_file(6, 20, list(SONG_FILE_COLUMNS)), encoding="utf-8")
    cleaned = cleaning.clean_songs(read_song_files(spark, str(tmp_path), split=True))
    cleaned.explain("extended")
    plan = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert plan.count("from_csv") <= 2  # whole records, and those put together of pieces
    quoted_records(spark, str(tmp_path)).where("number > 1").explain("extended")
    plan = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert "line#" not in plan  # no order of lines is asked for


def test_many_songs_are_several_files(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    lines = spark.range(60).selectExpr(
        "id % 7 as l_partkey", "id % 3 as l_suppkey", "cast(id % 7 + 1 as int) as l_linenumber",
        "double(id % 50 + 1) as l_quantity", "0.05d as l_discount", "0.02d as l_tax",
        "timestamp '1995-01-01' as l_shipdate",
    )
    lines.write.parquet(f"{root}/lineitem.parquet")
    parts = ("id as p_partkey", "concat('part ', id) as p_name", "'Brand#1' as p_brand", "cast(id as int) as p_size")
    spark.range(7).selectExpr(*parts).write.parquet(f"{root}/part.parquet")
    spark.range(3).selectExpr("id as s_suppkey", "concat('supplier ', id) as s_name").write.parquet(f"{root}/supplier.parquet")
    seen = []
    monkeypatch.setattr(queries, "_FILE_SONGS", 20)
    monkeypatch.setattr(queries, "scratch_dir", lambda spark, name: seen.append(scratch_dir(spark, name)) or seen[-1])
    songs = queries.QUERIES["song_file_split_scan"](spark, root)
    assert spark.read.text(seen[0]).select("_metadata.file_path").distinct().count() > 1
    expected = queries.QUERIES["clean_songs"](spark, root)
    assert songs.count() > 0 and songs.exceptAll(expected).isEmpty() and expected.exceptAll(songs).isEmpty()
