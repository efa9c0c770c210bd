"""Year and time buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def year_bucket(year: Column, length: int) -> Column:
    """First year of the bucket, as bigint."""
    return (F.floor(year / length) * length).cast("long")


def decade_label(decade: Column) -> Column:
    return F.concat(decade.cast("string"), F.lit("s"))


def period_label(start: Column, end: Column) -> Column:
    return F.concat_ws("-", start.cast("string"), end.cast("string"))


def time_bucket(moment: Column, length: str) -> Column:
    """Start of the fixed time bucket that holds ``moment``."""
    return F.window(moment, length)["start"]
