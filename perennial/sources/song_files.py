"""Song files: CSV with a header line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perennial.schemas import SONG_FILE_COLUMNS
from perennial.sources.quoted_lines import quoted_records

_QUOTES = {"mode": "PERMISSIVE", "quote": '"', "escape": '"'}


def read_song_files(
    spark: SparkSession,
    path: str,
    first_only: bool = False,
    multi_line: bool = True,
    split: bool = False,
) -> DataFrame:
    """All ``*.csv`` below ``path`` (or the one file it names), every cell as text.

    Columns are found by their names in the header, wherever they stand; others are left
    out. A missing one raises an error, and so does a file whose header differs from the
    first file's. Lines with too few fields come back with NULL in the missing columns.

    Quoted line breaks are understood, at the price of one task per file. Very large files
    are read in parts with ``split``, which understands them as well for one shuffle more, or,
    if they are known to hold none, with ``multi_line=False``.
    """

    def reader():
        found = (
            spark.read.option("header", True)
            .option("mode", "PERMISSIVE")
            .option("multiLine", multi_line)
            .option("quote", '"')
            .option("escape", '"')
        )
        return found if path.endswith(".csv") else found.option("pathGlobFilter", "*.csv")

    first = min(reader().schema("line string").csv(path).inputFiles())
    header = reader().csv(first).columns
    missing = [name for name in SONG_FILE_COLUMNS if name not in header]
    if missing:
        raise ValueError(f"{first} has no column {', '.join(missing)}")
    schema = T.StructType([T.StructField(name, T.StringType(), True) for name in header])
    if split:
        return _split_songs(spark, first if first_only else path, header, schema)
    songs = reader().schema(schema).option("enforceSchema", False).csv(first if first_only else path)
    return songs.select(*(F.col(f"`{name}`") for name in SONG_FILE_COLUMNS))


def _split_songs(spark: SparkSession, path: str, header: list[str], schema: T.StructType) -> DataFrame:
    records = quoted_records(spark, path).where("record <> ''")
    fields = ", ".join(f"`{field.name}` string" for field in schema.fields)
    cells = F.from_csv("record", F.lit(fields), _QUOTES)
    plain = ", ".join(f"c{k} string" for k in range(len(header)))
    # Grouped, one row a file, so that no other record is parsed to find it.
    heads = records.where("number = 1").groupBy("file").agg(F.first("record").alias("record"))
    heads = heads.select(F.from_csv("record", F.lit(plain), _QUOTES).alias("h"))
    others = heads.where(F.array(*(F.col(f"h.c{k}") for k in range(len(header)))) != F.array(*map(F.lit, header)))
    if others.limit(1).count():
        raise ValueError(f"the files of {path} have different headers")
    # As a generator, so that conditions on cells stay above it and a record is parsed once.
    songs = records.where("number > 1").select(F.inline(F.array(cells)))
    return songs.select(*(F.col(f"`{name}`") for name in SONG_FILE_COLUMNS))


def table_from_rows(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """Small in-memory table with inferred types."""
    return spark.createDataFrame(rows, names)
