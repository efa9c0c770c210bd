"""Landing tables kept as parquet folders under one root."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perennial.schemas import LANDING_TABLES

METRICS = "timeless_genre_metrics"


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def create_tables(spark: SparkSession, root: str) -> None:
    """Write every landing table empty. Data already there is dropped.

    Checkpoints belong under the same root, so that a reset is a new root: a
    stream that kept its old checkpoint would not read the history again.
    """
    for name, schema in LANDING_TABLES.items():
        writer = spark.createDataFrame([], schema).write.mode("overwrite")
        writer.option("partitionOverwriteMode", "static").parquet(table_path(root, name))


truncate_tables = create_tables


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(LANDING_TABLES[name]).parquet(table_path(root, name))


def register_views(frames: dict[str, DataFrame]) -> None:
    """Make frames, streaming ones too, known to SQL by name."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def table_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Row count per table; parquet answers it from the file footers."""
    counted = [
        frame.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, frame in frames.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def append_rows(df: DataFrame, root: str, name: str) -> None:
    """Append with the table's own types; columns ``df`` lacks become NULL."""
    columns = [
        (F.col(field.name) if field.name in df.columns else F.lit(None))
        .cast(field.dataType)
        .alias(field.name)
        for field in LANDING_TABLES[name].fields
    ]
    df.select(columns).write.mode("append").parquet(table_path(root, name))


def replace_days(df: DataFrame, path: str, day: str = "analysis_date") -> None:
    """Replace exactly the days that ``df`` holds, all or nothing per day.

    A run that fails before the commit leaves the old days as they were. One day's
    scores are one row per genre, so each day is written by a few tasks only.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )


def replace_day(df: DataFrame, path: str, value: str, day: str = "analysis_date") -> None:
    """Replace the rows of one day, also by none: the day's earlier rows go in any case."""
    df.where(F.col(day).cast("string") == value).drop(day).write.mode("overwrite").parquet(
        f"{path.rstrip('/')}/{day}={value}"
    )


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of data, on whatever storage it is; none there is no error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    return df.limit(n)
