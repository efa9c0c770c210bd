"""From raw song cells to typed songs."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perennial.functions.numbers import int_or, strict_int, to_number
from perennial.functions.text import strip_blanks, text_or
from perennial.schemas import NUMBER_DEFAULTS, SONG_FILE_COLUMNS, TEXT_COLUMNS

# Cell texts that mean "missing", as common CSV readers take them.
MISSING_CELLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def rename_columns(raw: DataFrame) -> DataFrame:
    """File header names to column names; frames already renamed pass unchanged."""
    return raw.withColumnsRenamed(SONG_FILE_COLUMNS)


def drop_incomplete(songs: DataFrame) -> DataFrame:
    """Drop rows with any cell that is NULL or spells "missing".

    Runs before numbers are read, so a cell that merely fails to parse does not cost
    the row.
    """
    present = [~F.col(name).isin(*MISSING_CELLS) for name in songs.columns]
    return songs.where(reduce(and_, present))


def read_numbers(songs: DataFrame) -> DataFrame:
    """Numbers as double, unreadable ones NULL; texts trimmed."""
    columns = {name: to_number(F.col(name)) for name in NUMBER_DEFAULTS}
    columns |= {name: strip_blanks(F.col(name)) for name in TEXT_COLUMNS}
    return songs.withColumns(columns)


def fill_defaults(songs: DataFrame) -> DataFrame:
    """Numbers cut to int with a default each; empty texts become 'Unknown'."""
    columns = {name: int_or(F.col(name), default) for name, default in NUMBER_DEFAULTS.items()}
    columns |= {name: text_or(F.col(name)) for name in TEXT_COLUMNS}
    return songs.withColumns(columns)


def prepare_songs(raw: DataFrame, ordered: bool = False) -> DataFrame:
    """Cleaned songs with unread numbers still NULL.

    The order by year costs a shuffle of the whole table; ask for it only where the
    reader sees it. Within a year the order is that of the file, which also lets a year
    with most of the songs spread over many tasks.
    """
    songs = read_numbers(drop_incomplete(rename_columns(raw)))
    if not ordered:
        return songs
    return songs.orderBy(F.col("year").asc_nulls_last(), F.col("index").try_cast("long"))


def clean_songs(raw: DataFrame) -> DataFrame:
    """Policy "default": a bad number takes its default."""
    columns = [*TEXT_COLUMNS, *NUMBER_DEFAULTS]
    return fill_defaults(prepare_songs(raw)).select(columns)


def clean_songs_or_drop(raw: DataFrame) -> DataFrame:
    """Policy "drop": one bad integer, the index included, costs the row."""
    songs = rename_columns(raw)
    numbers = ["index", *NUMBER_DEFAULTS]
    typed = songs.select(
        *[strip_blanks(F.coalesce(F.col(c), F.lit(""))).alias(c) for c in TEXT_COLUMNS],
        *[strict_int(F.col(c)).alias(c) for c in numbers],
    )
    return typed.na.drop("any", subset=numbers)


def replayable_songs(prepared: DataFrame) -> DataFrame:
    """Songs that the yearly replay sends: a song whose year is unread is in no year."""
    return prepared.where(F.col("year").isNotNull())
