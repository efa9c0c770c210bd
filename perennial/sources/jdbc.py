"""Relational tables over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str, table: str | None = None, query: str | None = None, **extra: str
) -> dict[str, str]:
    """Reader or writer options; exactly one of ``table`` and ``query``."""
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    options = {"url": url, **extra}
    options["dbtable" if table else "query"] = table or query
    return options


def split_options(
    column: str, lower: int, upper: int, partitions: int, fetch_size: int = 10_000
) -> dict[str, str]:
    """Options that read a table over many connections, split on a number column.

    The bounds only place the cuts: rows outside them are still read, by the first
    and the last partition.
    """
    if partitions < 1 or upper <= lower:
        raise ValueError("need at least one partition and upper > lower")
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_size),
    }


def read_table(
    spark: SparkSession, url: str, table: str, split: dict[str, str] | None = None, **extra: str
) -> DataFrame:
    options = jdbc_options(url, table=table, **extra)
    return spark.read.format("jdbc").options(**options, **(split or {})).load()


def id_split(
    spark: SparkSession, url: str, table: str, partitions: int, column: str = "id", **extra: str
) -> dict[str, str]:
    """Split options with bounds asked from the database, which has the key indexed."""
    bounds = read_query(
        spark, url, f"SELECT MIN({column}) AS low, MAX({column}) AS high FROM {table}", **extra
    ).first()
    low = bounds["low"] or 0
    high = max(bounds["high"] or 0, low + 1)
    return split_options(column, low, high, partitions)


def read_query(spark: SparkSession, url: str, query: str, **extra: str) -> DataFrame:
    """Result of a statement the database runs itself."""
    return spark.read.format("jdbc").options(**jdbc_options(url, query=query, **extra)).load()


def append_table(
    df: DataFrame, url: str, table: str, connections: int = 32, batch_size: int = 10_000, **extra: str
) -> None:
    """Append over at most ``connections`` connections; a failed write raises."""
    limits = {"numPartitions": str(connections), "batchsize": str(batch_size)}
    options = jdbc_options(url, table=table, **limits, **extra)
    df.write.format("jdbc").options(**options).mode("append").save()


def truncate_table(df: DataFrame, url: str, table: str, **extra: str) -> None:
    """Empty a table but keep its definition, grants and indexes."""
    options = jdbc_options(url, table=table, truncate="true", **extra)
    df.limit(0).write.format("jdbc").options(**options).mode("overwrite").save()
