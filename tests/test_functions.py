import datetime

import pytest
from pyspark.sql import functions as F

from perennial.functions import buckets, numbers, text


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_title_case_follows_every_non_letter(spark):
    given = ["hip-hop r&b", "o'neil 3rd", "ALT. METAL", "a1b c", "", None, "école déjà", "日本a"]
    expected = [v.title() if v is not None else None for v in given]
    assert column(spark, given, text.title_case) == expected


def test_strip_blanks_equals_python_strip(spark):
    given = ["  a b ", "\ta\n", " x　", "", "   ", None, "a\tb", " \t mixed \r\n "]
    expected = [v.strip() if v is not None else None for v in given]
    assert column(spark, given, text.strip_blanks) == expected


def test_text_or(spark):
    assert column(spark, ["a", "", None], text.text_or) == ["a", "Unknown", "Unknown"]


def test_iso_text_shows_a_fraction_only_if_there_is_one(spark):
    given = [
        datetime.datetime(2024, 1, 2, 3, 4, 5),
        datetime.datetime(2024, 1, 2, 3, 4, 5, 60),
        datetime.datetime(1999, 12, 31, 23, 59, 59, 999999),
    ]
    assert column(spark, given, text.iso_text, "timestamp") == [v.isoformat() for v in given]


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        ("12", 12.0), ("-6.9", -6.9), (" 7 ", 7.0), ("+3.", 3.0), (".5", 0.5), ("1e3", 1000.0),
        ("1,412", None), ("12d", None), ("12f", None), ("NaN", None), ("Infinity", None),
        ("0x1p3", None), ("loud", None), ("", None), (None, None), ("1.2.3", None), ("-", None),
    ],
)
def test_to_number(spark, given, expected):
    assert column(spark, [given], numbers.to_number) == [expected]


def test_int_or_truncates_toward_zero(spark):
    given = [12.7, -6.9, None, 3e9, float("nan")]
    assert column(spark, given, lambda c: numbers.int_or(c, 7), "double") == [12, -6, 7, 7, 7]


def test_strict_int(spark):
    given = ["12", " 12 ", "-3", "12.7", "1,412", "x", "", None]
    assert column(spark, given, numbers.strict_int) == [12, 12, -3, None, None, None, None, None]


def test_exact_sample_std(spark):
    df = spark.createDataFrame([(1,), (4,), (9,), (16,)], "x long")
    std = numbers.exact_sample_std(F.count("x"), F.sum("x"), F.sum(F.col("x") * F.col("x")))
    row = df.agg(std.alias("ours"), F.stddev_samp("x").alias("theirs")).first()
    assert row["ours"] == pytest.approx(row["theirs"], rel=1e-12)
    assert df.limit(1).agg(std.alias("one")).first()["one"] is None


def test_year_buckets_and_labels(spark):
    df = spark.createDataFrame([(1899,), (1900,), (1989,), (1990,)], "year int")
    got = df.select(
        buckets.year_bucket(F.col("year"), 10).alias("d"), buckets.year_bucket(F.col("year"), 5).alias("p")
    )
    assert dict(got.dtypes) == {"d": "bigint", "p": "bigint"}
    assert [tuple(r) for r in got.collect()] == [(1890, 1895), (1900, 1900), (1980, 1985), (1990, 1990)]
    labels = got.select(
        buckets.decade_label(F.col("d")), buckets.period_label(F.col("p"), F.col("p") + 4)
    ).collect()
    assert tuple(labels[2]) == ("1980s", "1985-1989")
