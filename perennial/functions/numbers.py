"""Tolerant number parsing. NULL marks a value that cannot be read."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_number(text: Column) -> Column:
    """Text to double; anything that is not a decimal number becomes NULL.

    The JVM would also read "12d", "NaN" and hexadecimal floats. A decimal number ends
    in a digit or a point and has no x, which is cheaper to see than a pattern.
    """
    trimmed = F.trim(text)
    last = F.substring(trimmed, -1, 1)
    decimal = (last.between("0", "9") | (last == ".")) & ~text.contains("x") & ~text.contains("X")
    return F.when(decimal, trimmed.try_cast("double"))


def truncated_int(number: Column) -> Column:
    """Number to int, cut toward zero; NULL where it does not fit."""
    return number.try_cast("int")


def int_or(number: Column, default: int) -> Column:
    return F.coalesce(truncated_int(number), F.lit(default))


def strict_int(text: Column) -> Column:
    """Text to int; fractions and other text become NULL."""
    return text.try_cast("int")


def exact_sample_std(count: Column, total: Column, squares: Column) -> Column:
    """Sample standard deviation from integer sums.

    The numerator is computed without rounding, so the result does not depend on
    the order in which partitions are merged. One row gives NULL.
    """
    n = count.cast("decimal(19,0)")
    spread = n * squares.cast("decimal(19,0)") - total.cast("decimal(19,0)") * total.cast("decimal(19,0)")
    pairs = count.cast("double") * (count - 1).cast("double")
    return F.when(count > 1, F.sqrt(spread.cast("double") / pairs))
