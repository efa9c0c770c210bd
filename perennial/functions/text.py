"""Text functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that Python's str.strip() removes, not only the blank.
_BLANKS = [chr(c) for c in range(0x3001) if chr(c).isspace()]

_WORD_OR_GAP = (
    r"([\p{javaLowerCase}\p{javaUpperCase}\p{javaTitleCase}]+"
    r"|[^\p{javaLowerCase}\p{javaUpperCase}\p{javaTitleCase}]+)"
)


def strip_blanks(text: Column) -> Column:
    """Trim all white space, tabs and line ends included.

    Trimming by a set of characters is slow, so only texts that need it take that way.
    """
    trimmed = F.trim(text)
    ragged = F.substring(trimmed, 1, 1).isin(_BLANKS) | F.substring(trimmed, -1, 1).isin(_BLANKS)
    return F.when(ragged, F.btrim(text, F.lit("".join(_BLANKS)))).otherwise(trimmed)


def text_or(stripped: Column, default: str = "Unknown") -> Column:
    """Stripped text; NULL and the empty string become ``default``."""
    return F.when(stripped != "", stripped).otherwise(F.lit(default))


def genre_key(genre: Column) -> Column:
    """Key under which spellings of one genre meet."""
    return F.lower(F.trim(genre))


def title_case(text: Column) -> Column:
    """Upper-case the first letter after every non-letter ("hip-hop r&b" -> "Hip-Hop R&B").

    ``initcap`` alone only looks at white space.
    """
    runs = F.regexp_extract_all(text, F.lit(_WORD_OR_GAP), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def iso_text(moment: Column) -> Column:
    """Zone-less ISO-8601 text; the fraction appears only when there is one."""
    seconds = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(moment, ".SSSSSS")
    return F.when(fraction == ".000000", seconds).otherwise(F.concat(seconds, fraction))
