import pandas as pd
import pytest
from pyspark.sql import functions as F

from keyscout.functions import patterns
from keyscout.functions.text import normalize, not_blank, without_table_prefix

CASES = {
    patterns.is_date: (
        ["2020-02-29", "2020/1/5", "20200503", "2020.12.31", "0001-01-01", "2020/02.29", "20000229"],
        ["2019-02-29", "0000-01-01", "2020-13-01", "2020-04-31", "2020-1/5", "202053", "2020-02-29\n", "16000229"],
    ),
    patterns.is_time: (["23:59", "23:59:59", "00:00"], ["24:00", "7:00", "12:60", "12:00:61", "12:00\n"]),
    patterns.is_timestamp: (
        ["20200503 235959", "2020-05-03 23:59:59", "2020/05/03 23:59:59.123", "2020-05-03 23:59:59.123456", "2020-1-1235959"],
        ["2020-05-03 23:59:59.1234", "2020-05-03", "2020.05.03 23:59:59", "2020-05-03T23:59:59", "2020-05-03 24:00:00"],
    ),
    patterns.is_integer: (["0", "-7", "+12", "10"], ["007", "", "1.0", "--1", "1 "]),
    patterns.is_float: (
        ["1.5", ".5", "1.", ".", "-.", "1.2E-3", "1,234.50", "-12,345,678.9"],
        ["15", "1,23.5", "1e5", "1.2.3", "0,123.4", ""],
    ),
    patterns.is_fraction: ([".123", ".123456"], [".12", "123", ".1234"]),
    patterns.is_number: (["1", "0", "-1.5", "00.5", "7."], [".5", "007", "1e3"]),
    patterns.has_chinese: (["中文a", "x龥"], ["abc", "é", ""]),
}


@pytest.mark.parametrize("check", CASES, ids=lambda c: c.__name__)
def test_recognisers(spark, check):
    good, bad = CASES[check]
    df = spark.createDataFrame([(v, True) for v in good] + [(v, False) for v in bad], "v string, want boolean")
    wrong = df.where(check(F.col("v")) != F.col("want")).collect()
    assert wrong == []


def test_marks_agree_with_recognisers(spark):
    values = sorted({v for good, bad in CASES.values() for v in good + bad})
    df = spark.createDataFrame([(v,) for v in values], "v string").withColumn("m", patterns.value_marks(F.col("v")))
    pairs = [
        (patterns.is_date, patterns.DATE_BIT), (patterns.is_time, patterns.TIME_BIT),
        (patterns.is_timestamp, patterns.TIMESTAMP_BIT), (patterns.is_float, patterns.FLOAT_BIT),
        (patterns.is_integer, patterns.INTEGER_BIT), (patterns.has_chinese, patterns.CHINESE_BIT),
    ]
    for check, bit in pairs:
        assert df.where(check(F.col("v")) != patterns.has_mark(F.col("m"), bit)).collect() == []


def test_dates_agree_with_the_calendar(spark):
    days = pd.date_range("1999-01-01", "2004-12-31").strftime("%Y-%m-%d").tolist()
    wrong = [f"{y}-{m:02d}-{d:02d}" for y in range(1999, 2005) for m in range(1, 13) for d in range(28, 33)]
    df = spark.createDataFrame([(d,) for d in sorted(set(days + wrong))], "v string")
    assert df.where(patterns.is_date(F.col("v")) != F.col("v").isin(days)).count() == 0


def test_blank_handling(spark):
    df = spark.createDataFrame([(None,), ("",), ("  ",), ("a ",), ("a",)], "v string")
    got = [tuple(r) for r in df.select(normalize("v"), F.coalesce(not_blank("v"), F.lit(False))).collect()]
    assert got == [("", False), ("", False), ("", False), ("a", True), ("a", True)]


def test_table_prefix(spark):
    df = spark.createDataFrame([("ods.a.b",), ("plain",)], "v string")
    assert [r[0] for r in df.select(without_table_prefix("v")).collect()] == ["a.b", "plain"]
