import math

import pytest
from conftest import at
from pyspark.sql import functions as F

from refillcast.functions import (
    days_between,
    feature_name,
    fill_defaults,
    guarded_log,
    log_features,
    na_fill_zero,
    parse_ts,
    path_level,
    strip_fraction,
    to_double,
    window_flag,
    window_start,
)


def one(spark, value, schema, *exprs):
    return tuple(spark.createDataFrame([(value,)], schema).select(*exprs).first())


def test_window_bounds_equal_months_between(spark):
    """The calendar form agrees with months_between on every day pair, at any time of day."""
    days = spark.range(1600).select(F.date_add(F.lit("2019-11-15").cast("date"), F.col("id").cast("int")).alias("a"))
    pairs = days.select("a", F.explode(F.expr("sequence(date_add(a, -400), date_add(a, 35))")).alias("b"))
    times = F.expr("array(array(0, 0), array(0, 86399), array(86399, 0), array(40001, 40000))")
    pairs = pairs.withColumn("s", F.explode(times)).select(
        "a", "b",
        F.expr("months_between(timestamp_seconds(unix_date(a) * 86400 + s[0]),"
               " timestamp_seconds(unix_date(b) * 86400 + s[1] + 0.999))").alias("m"),
    )
    wrong = []
    for months in (1, 2, 3, 6, 12):
        inside = (F.col("b") >= window_start("a", months)) & (F.col("b") <= F.col("a"))
        before = inside & (F.col("b") < F.col("a"))
        wrong += [
            F.count_if(F.col("m").between(0, months) != inside),
            F.count_if(((F.col("m") > 0) & (F.col("m") <= months)) != before),
        ]
    assert set(pairs.agg(*wrong).first()) == {0}


@pytest.mark.parametrize("event, months, inside", [
    ("2022-03-15 18:00", 1, True),
    ("2021-03-15", 12, True),
    ("2021-03-14", 12, False),
    ("2022-03-16", 12, False),
])
def test_window_flag(spark, event, months, inside):
    df = spark.createDataFrame([(at("2022-03-15 10:00"), at(event))], "a timestamp, e timestamp")
    assert df.select(window_flag("a", "e", months)).first()[0] == int(inside)


def test_month_ends(spark):
    df = spark.createDataFrame(
        [(at("2022-03-31 01:00"), at("2022-02-28 23:00")), (at("2024-02-29"), at("2023-02-28"))],
        "a timestamp, e timestamp",
    )
    assert [r[0] for r in df.select(F.months_between("a", "e")).collect()] == [1.0, 12.0]


def test_fraction_and_bad_time(spark):
    assert one(spark, "2022-01-02 03:04:05.123", "c string", strip_fraction("c"))[0] == "2022-01-02 03:04:05"
    text = F.date_format(parse_ts("c"), "yyyy-MM-dd HH:mm:ss")
    assert one(spark, "2022-01-02 03:04:05.123", "c string", text)[0] == "2022-01-02 03:04:05"
    assert one(spark, "junk", "c string", parse_ts("c"))[0] is None


def test_to_double_never_raises(spark):
    df = spark.createDataFrame([("1.5",), ("",), ("x",), (None,)], "c string")
    assert [r[0] for r in df.select(to_double("c")).collect()] == [1.5, None, None, None]


def test_days_between_keeps_fraction(spark):
    df = spark.createDataFrame([(at("2022-01-03 12:00"), at("2022-01-01"))], "a timestamp, b timestamp")
    assert df.select(days_between("a", "b")).first()[0] == 2.5


def test_path_level(spark):
    levels = [path_level("c", i) for i in range(3)]
    assert one(spark, "a > b", "c string", *levels) == ("a", "b", "Unknown")
    assert one(spark, None, "c string", *levels) == ("Unknown",) * 3
    assert one(spark, "a|b", "c string", path_level("c", 1, "|")) == ("b",)


def test_defaults(spark):
    df = spark.createDataFrame([(None, None, 1)], "n double, t string, k int")
    assert tuple(fill_defaults(df).first()) == (0.0, "Unknown", 1)
    assert tuple(fill_defaults(df, cols=["n"]).first()) == (0.0, None, 1)
    assert tuple(na_fill_zero(df).first()) == (0.0, None, 1)


def test_guarded_log(spark):
    df = spark.createDataFrame([(0.0,), (-2.0,), (None,), (0.5,)], "x double")
    assert [r[0] for r in df.select(guarded_log("x")).collect()] == [0.0, 0.0, None, math.log(0.5)]
    assert log_features(df, ["x"]).columns == ["x", "log__x"]


def test_feature_name():
    assert feature_name("source", 2, 6, "utm_source") == "source_2__last6m_utm_source"
