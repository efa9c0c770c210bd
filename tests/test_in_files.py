"""Streams of files: batches stay eight, their files grow with the table."""

from perennial.plans import queries
from perennial.streaming import landing
from perennial.streaming.control import finish
from perennial.streaming.timers import state_partitions


def _batches(spark, rows, root):
    seen = []
    stream = queries._in_files(rows, f"{root}/in", rows)
    sink = lambda batch, _id: seen.append((batch.count(), len(batch.inputFiles())))
    finish(landing.start_query(stream, sink, f"{root}/checkpoint"))
    return seen


def test_many_rows_are_several_files_a_batch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "_FILE_ROWS", 10)
    batches = _batches(spark, spark.range(240), str(tmp_path))
    assert len(batches) == 8 and sum(n for n, _files in batches) == 240
    assert len(spark.read.parquet(f"{tmp_path}/in").inputFiles()) == 24


def test_few_rows_are_a_file_a_batch(spark, tmp_path):
    batches = _batches(spark, spark.range(240), str(tmp_path))
    assert len(batches) == 8 and len(spark.read.parquet(f"{tmp_path}/in").inputFiles()) == 8


def test_state_has_no_more_partitions_than_buckets(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, "200")
    try:
        with state_partitions(spark, 32):
            assert spark.conf.get(key) == "32"
        assert spark.conf.get(key) == "200"
        with state_partitions(spark, 500):
            assert spark.conf.get(key) == "200"
    finally:
        spark.conf.set(key, before)
