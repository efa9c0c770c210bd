"""Levels of merged batches: every batch in one folder, few folders, repeats."""

import os

import pytest
from pyspark.sql import functions as F

from perennial.streaming import levels


@pytest.mark.parametrize("fanout", [2, 3, 10])
def test_folders_hold_each_batch_once(fanout):
    for batches in range(1, 1001):
        covered = []
        for folder in levels.folders("p", batches, fanout):
            if "batch_id=" in folder:
                covered.append(int(folder.rsplit("=", 1)[1]))
            else:
                level, number = map(int, folder.split("/")[-2:])
                covered += range(number * fanout**level, (number + 1) * fanout**level)
        assert sorted(covered) == list(range(batches))
    assert len(levels.folders("p", 300, 10)) == 3 and len(levels.folders("p", 299, 10)) == 20


def sums(df):
    return df.groupBy("k").agg(F.sum("n").alias("n"))


def test_sums_stay_right_and_folders_few(spark, root):
    sink = levels.levelled_sink(spark, f"{root}/out", sums, sums, fanout=3)
    expected = {}
    for number in range(20):
        rows = [(k % 4, number + k) for k in range(5)]
        for k, n in rows:
            expected[k] = expected.get(k, 0) + n
        frame = spark.createDataFrame(rows, "k long, n long").coalesce(1)
        sink(frame, number)
        if number in (8, 17):  # a batch whose merges are repeated
            sink(frame, number)
        if number in (0, 8, 9, 19):
            assert {r["k"]: r["n"] for r in sums(levels.read_levels(spark, f"{root}/out", 3)).collect()} == expected
    left = [d for d, _s, names in os.walk(root) if any(n.endswith(".parquet") for n in names) and "noted" not in d]
    assert len(left) <= 3 * 3 and not os.path.exists(f"{root}/out/batch_id=0")


def test_nothing_has_landed(spark, root):
    with pytest.raises(FileNotFoundError):
        levels.read_levels(spark, f"{root}/none")
