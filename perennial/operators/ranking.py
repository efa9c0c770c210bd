"""Top-k, newest-n and row numbers that never gather a big group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perennial.session import scratch_dir

_LANES = 512
_TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)
_ROWS_PER_CHUNK = 1_000_000


def top_k(df: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """First ``k`` rows; each task keeps only its own best ``k``."""
    return df.orderBy(*order).limit(k)


def ranked_top_k(df: DataFrame, k: int, *order: Column | str, rank: str = "ranking") -> DataFrame:
    """First ``k`` rows with their place. The window sees these ``k`` rows only."""
    return top_k(df, k, *order).withColumn(rank, F.row_number().over(Window.orderBy(*order)))


def _since_hour(df: DataFrame, moment: str, n: int) -> Column:
    """Whether a row belongs to the hour of the n-th newest row or a later one; with fewer
    than ``n`` rows that have a moment, every row does."""
    cut = (
        df.where(F.col(moment).isNotNull())
        .groupBy(F.date_trunc("hour", F.col(moment)).alias("_hour"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_newer", F.sum("_n").over(Window.orderBy(F.col("_hour").desc())))
        .where(F.col("_newer") >= n)
        .agg(F.max("_hour"))
        .scalar()
    )
    return cut.isNull() | (F.col(moment) >= cut)


def newest(df: DataFrame, moment: str, n: int) -> DataFrame:
    """The ``n`` newest rows, newest first.

    Rows of one moment are ordered by all other columns, so those still tied are
    equal. Rows are counted per hour first, which reads one column; everything before the
    hour that holds the n-th newest row is filtered out where it is read, whatever ``n``
    and the session's settings are. Groups of tasks trim the small rest to ``n`` each, so
    that an hour with very many rows does not reach the last step whole. A ``moment`` that
    is no time has no hours, and all its rows are trimmed in groups.
    """
    since = _since_hour(df, moment, n) if isinstance(df.schema[moment].dataType, _TIMES) else F.lit(True)
    order = [F.col(moment).desc_nulls_last()]
    order += [F.col(c).asc_nulls_first() for c in df.columns if c != moment]
    lane = Window.partitionBy("_lane").orderBy(*order)
    trimmed = (
        df.where(since)
        .withColumn("_lane", F.spark_partition_id() % _LANES)
        .withColumn("_place", F.row_number().over(lane))
        .where(F.col("_place") <= n)
        .drop("_lane", "_place")
    )
    return trimmed.orderBy(*order).limit(n)


def top_per_group(df: DataFrame, group: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """First ``n`` rows of each group; tasks trim their share before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn(rank, place).where(F.col(rank) <= n)


def row_numbers_by_value(
    df: DataFrame, group: list[str], order: dict[str, str], rank: str = "rank"
) -> DataFrame:
    """ROW_NUMBER per group over columns of few distinct values ("asc" or "desc" each).

    Returns the group and order columns with the number. Rows that agree in these are
    interchangeable, so it is enough to count them: the whole table shrinks to one
    row per value before anything is shuffled, the window runs over the counts, and
    the numbers are dealt out again in chunks that spread over the cluster.
    """
    keys = [F.col(c).desc() if way == "desc" else F.col(c).asc() for c, way in order.items()]
    before = Window.partitionBy(*group).orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    counted = df.groupBy(*group, *order).agg(F.count(F.lit(1)).alias("_n"))
    placed = counted.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    starts = F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(_ROWS_PER_CHUNK).cast("long"))
    chunks = placed.withColumn("_start", F.explode(starts)).repartition(*group, *order, "_start")
    last = F.least(F.col("_start") + _ROWS_PER_CHUNK, F.col("_n")) - 1
    return chunks.select(
        *group,
        *order,
        F.explode(F.sequence(F.col("_start") + F.col("_before") + 1, last + F.col("_before") + 1)).alias(rank),
    )


_PART_BITS = 33  # of an increasing id: the row's place in its task


def _in_order(df: DataFrame, order: list[Column], parts: int | None) -> DataFrame:
    """The rows sorted and written, with ``_id``: their part and their place in it.

    Ranges of the order are dealt by sampled bounds. Rows that are equal in it are spread by
    their other columns, and then by where they were read, so no value is one part. Bounds are
    drawn anew each time, hence the rows are written before they are counted.
    """
    spark = df.sparkSession
    read_at = F.shiftright(F.monotonically_increasing_id(), 10)
    rows = df.withColumn("_read_at", read_at)
    ties = [F.xxhash64(*df.columns), F.col("_read_at")]
    dealt = rows.repartitionByRange(parts, *order, *ties) if parts else rows.repartitionByRange(*order, *ties)
    numbered = dealt.sortWithinPartitions(*order, *ties).select(*df.columns, F.monotonically_increasing_id().alias("_id"))
    path = scratch_dir(spark, "ordered")
    numbered.write.parquet(path)
    return spark.read.schema(numbered.schema).parquet(path)


def number_rows(df: DataFrame, *order: Column, rank: str = "ranking", parts: int | None = None) -> DataFrame:
    """ROW_NUMBER over all rows, whatever their number.

    Rows are dealt to parts by ranges of the order and sorted there; a part's rows are counted,
    and the counts of the parts before it are added to a row's place in its own. The one
    window runs over a row per part. Rows equal in ``order`` are numbered in an order of
    their own. ``parts`` defaults to the session's shuffle partitions.
    """
    rows = _in_order(df, list(order), parts)
    part = F.shiftright("_id", _PART_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    place = F.col("_id").bitwiseAND(F.lit((1 << _PART_BITS) - 1)) + 1
    numbered = rows.withColumn("_part", part).join(offsets, "_part")
    return numbered.select(*df.columns, (F.col("_before") + place).cast("long").alias(rank))


def rank_by_score(scores: DataFrame, score: str = "timeless_score", name: str = "genre") -> DataFrame:
    """ROW_NUMBER over all rows, best score first, then by name; rows without a score last.
    However many rows share a score or a beginning of their names, no part grows with them."""
    return number_rows(scores, F.col(score).desc_nulls_last(), F.col(name).asc_nulls_first())
