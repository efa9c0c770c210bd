"""CSV records with quoted line breaks, from files that are read in parts.

A reader that understands quoted line breaks has to read a file from its begin, in one task.
Here files are read as lines, in parts like any text. Whether a line break lies inside quotes
depends only on whether the quotes before it are odd or even in number: every part counts its
own, the parts of a file are added up in order, and each part then knows whether it begins
inside quotes and which record is its first. A second reading puts the records of a part
together where they are read; nothing of them is shuffled but the pieces of records that reach
over the end of a part, at most two a part.

Quotes inside a quoted cell have to be doubled, and cells that hold quotes have to be quoted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from perennial.session import scratch_dir

_PART = ["file", "part"]


def _lines(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """Lines with their file and the place where their part of it begins. A task reads the
    lines of a part one after the other."""
    reader = spark.read if path.endswith(suffix) else spark.read.option("pathGlobFilter", f"*{suffix}")
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("part"),
        "value",
    )


def _opened(lines: DataFrame) -> DataFrame:
    """(file, part, place, open): a number of its own for each part, and whether it begins
    inside quotes. One row per part."""
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    parts = lines.groupBy(*_PART).agg(F.sum(quotes % 2).alias("quotes"))
    before = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    opened = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1
    return parts.select(*_PART, F.monotonically_increasing_id().alias("place"), opened.alias("open"))


_RECORDS = "place long, nth long, whole boolean, record string"


def _part_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of each part, numbered from 1 by those that begin in it; 0 is what remains
    of the one before. Not ``whole`` are those that begin before the part or go on after it."""
    place, inside, nth = None, 0, 0
    held: list[str] = []  # the lines so far of the record that the last line belongs to

    def rows(nths: np.ndarray, whole: np.ndarray, records: pa.Array) -> pa.RecordBatch:
        places = np.full(len(nths), place, dtype=np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(places), pa.array(nths), pa.array(whole), records], names=["place", "nth", "whole", "record"]
        )

    def last(ended: bool) -> pa.RecordBatch:
        return rows(np.array([nth]), np.array([ended and nth > 0]), pa.array(["\n".join(held)]))

    for batch in batches:
        places = batch.column("place").to_numpy()
        changes = [0, *(np.flatnonzero(places[1:] != places[:-1]) + 1), len(places)]
        for first, end in zip(changes, changes[1:]):
            if first == end:
                continue
            if place != places[first]:
                if held:
                    yield last(not inside)
                place, nth, held = places[first], 0, []
                inside = int(batch.column("open")[first].as_py())
            values = batch.column("value").slice(first, end - first)
            odd = pc.bit_wise_and(pc.count_substring(values, '"'), 1).to_numpy(zero_copy_only=False)
            within = np.concatenate([[inside], inside + np.cumsum(odd)]) % 2  # a line begins inside quotes
            inside = int(within[-1])
            starts = np.flatnonzero(within[:-1] == 0)
            held += values[: starts[0] if len(starts) else None].to_pylist()
            if not len(starts):
                continue
            if held:
                yield last(True)
            if len(starts) > 1:  # all but the last end where the next one begins
                lines = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), values)
                nths = np.arange(nth + 1, nth + len(starts))
                yield rows(nths, np.ones(len(nths), dtype=bool), pc.binary_join(lines, "\n"))
            nth += len(starts)
            held = values[starts[-1] :].to_pylist()
    if held:
        yield last(not inside)


def quoted_records(spark: SparkSession, path: str, suffix: str = ".csv") -> DataFrame:
    """(file, number, record) of all records of the files at ``path``, numbered from 1 in each
    file; line breaks inside quotes are line feeds. Blank lines outside quotes are records
    without text."""
    lines = _lines(spark, path, suffix)
    # One row per part of a file, here and below: sent to all tasks, so that lines stay where
    # they are read.
    opened = _settled(_opened(lines), "parts")
    placed = lines.join(F.broadcast(opened), _PART).select("place", "open", "value")
    found = _settled(placed.mapInArrow(_part_records, _RECORDS), "records")
    begins = opened.join(found.groupBy("place").agg(F.max("nth").alias("begins")), "place", "left")
    before = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begun = begins.select(*_PART, "place", F.coalesce(F.sum("begins").over(before), F.lit(0)).alias("begun"))
    numbered = found.join(F.broadcast(begun), "place").select(
        "file", "part", (F.col("begun") + F.col("nth")).alias("number"), "whole", "record"
    )
    pieces = F.array_sort(F.collect_list(F.struct("part", "record")))
    joined = (
        numbered.where("NOT whole")
        .groupBy("file", "number")
        .agg(F.array_join(F.transform(pieces, lambda x: x["record"]), "\n").alias("record"))
    )
    return numbered.where("whole").select("file", "number", "record").unionByName(joined)


def _settled(rows: DataFrame, name: str) -> DataFrame:
    target = scratch_dir(rows.sparkSession, name)
    rows.write.parquet(target)
    return rows.sparkSession.read.schema(rows.schema).parquet(target)
