"""Landed sums that stay few however long a stream runs.

Every batch lands a folder of its own. Each ``fanout`` folders of a level are merged into one
of the next level while the stream goes on, so a sum is rewritten about log(batches) times and
a reader opens fewer than ``fanout`` folders a level. Which folders hold the batches up to n
follows from the digits of n to the base ``fanout``; only n is noted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perennial.sources.tables import drop_folder
from perennial.streaming.landing import BatchSink, Shape


def _folder(path: str, level: int, number: int) -> str:
    return f"{path}_levels/{level}/{number}" if level else f"{path}/batch_id={number}"


def folders(path: str, batches: int, fanout: int) -> list[str]:
    """The folders that hold the first ``batches`` batches, each batch in one of them."""
    found, level = [], 0
    while batches:
        held = batches % fanout
        found += [_folder(path, level, batches - held + k) for k in range(held)]
        batches, level = batches // fanout, level + 1
    return found


def _merges(batches: int, fanout: int) -> list[tuple[int, int]]:
    """(level, number) of the folders that are full with this many batches."""
    full, level = [], 1
    while batches and batches % fanout == 0:
        batches //= fanout
        full.append((level, batches - 1))
        level += 1
    return full


def levelled_sink(
    spark: SparkSession, path: str, shape: Shape, merge: Callable[[DataFrame], DataFrame], fanout: int = 10
) -> BatchSink:
    """Land ``shape`` of each batch and ``merge`` full levels; keep ``fanout`` for the life of
    a path. A batch that runs again repeats its merges: what they read is deleted one batch
    later, which also spares a reader that has just looked up the folders."""

    def inputs(level: int, number: int) -> list[str]:
        return [_folder(path, level - 1, number * fanout + k) for k in range(fanout)]

    def write(batch: DataFrame, batch_id: int) -> None:
        for level, number in _merges(batch_id, fanout):
            for folder in inputs(level, number):
                drop_folder(spark, folder)
        shape(batch).write.mode("overwrite").parquet(_folder(path, 0, batch_id))
        for level, number in _merges(batch_id + 1, fanout):
            merge(spark.read.parquet(*inputs(level, number))).write.mode("overwrite").parquet(
                _folder(path, level, number)
            )
        noted = spark.range(1).select(F.lit(batch_id + 1).cast("long").alias("batches"))
        noted.write.mode("overwrite").parquet(f"{path}_levels/noted/batch_id={batch_id}")
        drop_folder(spark, f"{path}_levels/noted/batch_id={batch_id - 2}")

    return write


def read_levels(spark: SparkSession, path: str, fanout: int = 10) -> DataFrame:
    """All rows landed so far, those of merged batches merged; fails if nothing has landed."""
    try:
        batches = spark.read.parquet(f"{path}_levels/noted").agg(F.max("batches")).first()[0]
    except AnalysisException as missing:
        raise FileNotFoundError(f"nothing has landed below {path}") from missing
    return spark.read.parquet(*folders(path, batches, fanout))
