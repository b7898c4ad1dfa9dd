"""Scalar functions on edge values."""

import math

import pytest
from pyspark.sql import functions as F

from incident_engine.functions import scores, text, timestamps


def one(spark, value, function, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(function("v").alias("r")).first()["r"]


@pytest.mark.parametrize("parse, value, expected", [
    (timestamps.parse_iso, "2025-05-20T16:02:26.000", "2025-05-20 16:02:26"),
    (timestamps.parse_iso, "junk", None),
    (timestamps.parse_iso, None, None),
    (timestamps.parse_month, "2024-02", "2024-02-01 00:00:00"),
    (timestamps.parse_month, "2024-13", None),
    (timestamps.parse_12h, "01/02/2020 12:00:00 AM", "2020-01-02 00:00:00"),
    (timestamps.parse_12h, "01/02/2020 12:30:00 PM", "2020-01-02 12:30:00"),
    (timestamps.parse_12h, "01/02/2020 13:02:03 PM", None),
    (timestamps.parse_24h_marked, "01/02/2020 13:02:03 PM", "2020-01-02 13:02:03"),
    (timestamps.parse_24h_marked, "01/02/2020 01:02:03 PM", "2020-01-02 01:02:03"),
    (timestamps.parse_24h_marked, "1/2/2020 1:02:03 am", "2020-01-02 01:02:03"),
    (timestamps.parse_24h_marked, "01/02/2020 13:02:03", None),
    (timestamps.parse_24h_marked, "2020-01-02T13:02:03", None),
    (timestamps.parse_first, "2020-01-02T13:02:03", "2020-01-02 13:02:03"),
    (timestamps.parse_first, "01/02/2020 13:02:03 PM", "2020-01-02 13:02:03"),
    (timestamps.parse_first, "junk", None),
])
def test_parse(spark, parse, value, expected):
    assert one(spark, value, lambda c: timestamps.to_text(parse(c))) == expected


@pytest.mark.parametrize("day, following, previous", [
    ("2001-11-04 10:00:00", "2001-12-01", "2001-10-01"),
    ("2001-12-01 00:00:00", "2002-01-01", "2001-11-01"),
    ("2024-01-31 23:59:59", "2024-02-01", "2023-12-01"),
])
def test_month_steps(spark, day, following, previous):
    ts = lambda f: one(spark, day, lambda c: f(F.col(c).cast("timestamp")).cast("string"))
    assert ts(timestamps.next_month) == following
    assert ts(timestamps.previous_month) == previous


def test_calendar_features(spark):
    df = spark.sql("select date '2024-07-01' as ds").withColumns(timestamps.calendar_features("ds"))
    row = df.first()
    assert (row["month"], row["year"], row["days_in_month"], row["is_holiday"]) == (7, 2024, 31, 1)
    assert row["day_of_week"] == 0  # a Monday
    assert row["month_sin"] == pytest.approx(math.sin(2 * math.pi * 7 / 12))
    assert row["day_of_week_cos"] == 1.0


def test_first_of_month_and_leap_year(spark):
    row = spark.range(1).select(
        timestamps.first_of_month(F.lit(2024), F.lit(2)).alias("d")).withColumn(
        "n", timestamps.days_in_month("d")).first()
    assert (str(row["d"]), row["n"]) == ("2024-02-01", 29)


@pytest.mark.parametrize("value, expected", [
    ("12.0", "12"), ("12", "12"), ("1.05", "1.05"), ("10.00", "10.00"), (".0", ""), (None, None)])
def test_strip_float_suffix(spark, value, expected):
    assert one(spark, value, text.strip_float_suffix) == expected


def test_to_double(spark):
    assert one(spark, "1.5", text.to_double) == 1.5
    assert one(spark, "REDACTED", text.to_double) is None


def test_polygon_text(spark):
    kind = "array<struct<latitude: string, longitude: string>>"
    points = [("1.0", "2.0"), ("3.0", "4.0"), ("5.0", "6.0")]
    assert one(spark, points, text.polygon_text, kind) == "1.0,2.0:3.0,4.0:5.0,6.0:1.0,2.0"
    assert one(spark, [], text.polygon_text, kind) == ""


def test_request_texts(spark):
    row = spark.sql("select 'f' as f, 'a b c' as n, '1.0,2.0:1.0,2.0' as p, '2024-02' as m").select(
        text.request_path("f", "n").alias("path"), text.request_body("p", "m").alias("body")).first()
    assert row["path"] == "/f/a%20b%20c/boundary"
    assert row["body"] == "poly=1.0%2C2.0%3A1.0%2C2.0&date=2024-02"


def test_scores(spark):
    df = spark.sql("select * from values (0D, 1L), (0.5D, 1L), (0.7D, 1L), (0.7D, 0L) as t(mu, n)")
    p = scores.chance_of_any("mu")
    rows = df.select(p.alias("p"), scores.hit_flag(p, "n").alias("f"),
                     scores.hit_flag(p, "n", 0.3).alias("low")).collect()
    assert [r["f"] for r in rows] == [0, 0, 1, 0]
    assert [r["low"] for r in rows] == [0, 1, 1, 0]
    assert rows[1]["p"] == pytest.approx(1 - math.exp(-0.5))
    assert one(spark, -3.0, scores.at_least_zero, "double") == 0.0
