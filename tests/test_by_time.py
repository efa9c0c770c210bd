import datetime

from pyspark.sql import functions as F

from perennial.plans.queries import _by_time


def test_rows_are_dealt_once_and_lie_in_files_by_time(spark, tmp_path):
    rows = spark.range(100).select(F.col("id"), F.timestamp_seconds("id").alias("at"))
    rows = rows.unionByName(spark.sql("SELECT -1L AS id, CAST(NULL AS timestamp) AS at"))
    bounds = [datetime.datetime.fromtimestamp(s, datetime.UTC) for s in (30, 60)]
    _by_time(rows, "at", bounds, f"{tmp_path}/spans")
    ids = [sorted(r.id for r in spark.read.parquet(f"{tmp_path}/spans/{n}").collect()) for n in range(3)]
    assert ids == [list(range(30)), list(range(30, 60)), list(range(60, 100))]
    dealt = spark.read.parquet(f"{tmp_path}/spans_dealt")
    assert dealt.count() == 100 and dealt.select("span").distinct().count() == 3
