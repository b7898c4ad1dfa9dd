"""Cleaning, features, split and both forecast models."""

import datetime as dt

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from incident_engine.operators import features, forecast


def series(spark, **areas):
    """Monthly counts from 2020-01 on, one list per area; none leaves the month out."""
    rows = [(area, 2020 + i // 12, i % 12 + 1, n) for area, values in areas.items()
            for i, n in enumerate(values) if n is not None]
    df = spark.createDataFrame(rows, "AREA string, year int, month int, crime_count long")
    return features.with_calendar(df)


def test_columns_are_found_by_name(spark):
    df = spark.createDataFrame([], "id int, `Date Rptd` string, `DATE OCC` string, `Community Area` string")
    assert features.find_column(df, "date") == "Date Rptd"
    assert features.find_column(df, "area") == "Community Area"
    with pytest.raises(ValueError, match="ward"):
        features.find_column(df, "ward")
    with pytest.raises(ValueError, match="missing columns"):
        features.require_columns(df, ["id", "AREA"])


def test_cleaning(spark):
    df = spark.createDataFrame([
        ("05/01/2020 13:00:00 PM", "7.0"), ("2020-06-01T00:00:00", "8"), ("junk", "8"), (None, "8"),
        ("05/01/2020 01:00:00 AM", None), ("05/01/2020 01:00:00 AM", "nan")], "Date string, Area string")
    rows = features.clean_incidents(df).collect()
    assert [(r["AREA"], r["year"], r["month"]) for r in rows] == [("7", 2020, 5), ("8", 2020, 6)]
    times = spark.createDataFrame([(dt.datetime(2021, 2, 3), 4.0)], "date timestamp, area double")
    row = features.clean_incidents(times).first()
    assert (row["AREA"], row["month"]) == ("4", 2)


RATE = "year int, month int, AREA string, unemployment_rate double"


def test_rate_join(spark):
    counts = series(spark, a=[1, 2, 3])
    rate = spark.createDataFrame([(2020, 1, "a", 4.5), (2020, 2, "a", None), (2020, 1, "b", 9.0)], RATE)
    got = [r["unemployment_rate"] for r in features.with_rate(counts, rate).orderBy("ds").collect()]
    assert got == [4.5, 5.0, 5.0]
    double = features.with_rate(counts, rate.union(rate.filter("month = 1 and AREA = 'a'")))
    assert double.count() == 4
    assert {r["unemployment_rate"] for r in features.with_rate(counts, None).collect()} == {5.0}


@pytest.mark.parametrize("n, train, test", [(1, 0, 0), (2, 0, 0), (3, 2, 1), (10, 8, 2), (11, 8, 3)])
def test_split(spark, n, train, test):
    rows = forecast.split_series(series(spark, a=[5] * n)).orderBy("ds").collect()
    assert [r["is_test"] for r in rows] == [False] * train + [True] * test


def test_split_share(spark):
    rows = forecast.split_series(series(spark, a=[5] * 10), test_share=0.35).collect()
    assert sum(r["is_test"] for r in rows) == 4


def by_hand(values):
    """Trend times month index, fitted on the first rows; gaps are none."""
    known = [(i, v) for i, v in enumerate(values) if v is not None]
    train = known[: len(known) - int(np.ceil(len(known) * 0.2))]
    t0 = known[0][0]
    t, y = np.array([i - t0 for i, _ in train], float), np.array([v for _, v in train], float)
    slope, intercept = np.polyfit(t, y, 1)
    trend = lambda i: intercept + slope * (i - t0)
    index = {m: np.mean([v / trend(i) for i, v in train if i % 12 == m]) for m in {i % 12 for i, _ in train}}
    return lambda i: max(trend(i) * index.get(i % 12, 1.0), 0.0), known, len(train)


VALUES = {
    "steady": [10 + (i % 12) + i // 3 for i in range(40)],
    "gaps": [None if i in (0, 5, 6, 20) else 30 + (i * 7) % 11 for i in range(30)],
    "falling": [40 - 3 * i for i in range(13)],
    "short": [4, 9, 1],
}


@pytest.fixture(scope="module")
def split(spark):
    return forecast.split_series(series(spark, **VALUES))


def test_trend_and_season(spark, split):
    models = forecast.fit_trend_season(split)
    fitted = {(r["AREA"], r["ds"]): r["yhat"] for r in forecast.fit_predict_trend_season(split).collect()}
    asked = forecast.horizon(models, 2025, 11, 4)
    ahead = {(r["AREA"], r["ds"]): r["yhat"] for r in forecast.predict_trend_season(asked, models).collect()}
    errors = {r["AREA"]: r["mse"] for r in
              forecast.holdout_mse(forecast.fit_predict_trend_season(split)).collect()}
    day = lambda i: dt.date(2020 + i // 12, i % 12 + 1, 1)
    for area, values in VALUES.items():
        predict, known, trained = by_hand(values)
        for i, _ in known:
            assert fitted[area, day(i)] == pytest.approx(predict(i), abs=1e-9)
        for i in range(70, 74):
            assert ahead[area, day(i)] == pytest.approx(predict(i), abs=1e-9)
        assert errors[area] == pytest.approx(np.mean([(v - predict(i)) ** 2 for i, v in known[trained:]]))
    assert ahead["falling", day(73)] == 0.0
    assert len(ahead) == 4 * len(VALUES)


def test_horizon_rolls_over_the_year_and_takes_areas(spark, split):
    models = forecast.fit_trend_season(split)
    rows = forecast.horizon(models, 2024, 11, 3, areas=["steady", "unknown"]).orderBy("ds").collect()
    assert [(r["AREA"], r["year"], r["month"]) for r in rows] == [
        ("steady", 2024, 11), ("steady", 2024, 12), ("steady", 2025, 1)]
    wanted = spark.createDataFrame([("short",), ("unknown",)], "AREA string")
    assert forecast.horizon(models, 2024, 1, 5, areas=wanted).count() == 5


REQUEST = "AREA string, year int, month int, unemployment_rate double"


def test_unknown_area_is_an_error(spark, split):
    asked = spark.createDataFrame([("nowhere", 2024, 1, 5.0)], REQUEST)
    with pytest.raises(PySparkException, match="no model for area nowhere"):
        forecast.predict_trend_season(asked, forecast.fit_trend_season(split)).collect()


@pytest.fixture(scope="module")
def ridge(spark):
    rng = np.random.default_rng(3)
    season = 1 + 0.4 * np.sin(2 * np.pi * np.arange(96) / 12)
    data = {"a": [int(v) for v in (100 + np.arange(96)) * season + rng.normal(0, 1, 96)], "b": [3, 2, 5, 4]}
    table = forecast.split_series(features.with_rate(series(spark, **data), None))
    return table, forecast.fit_ridge(table).cache()


def test_ridge_follows_trend_and_season(spark, ridge):
    table, models = ridge
    assert {r["AREA"]: r["n_train"] for r in models.collect()} == {"a": 76, "b": 3}
    asked = table.select("AREA", "year", "month", "unemployment_rate", "ds", "is_test", F.col("crime_count").alias("y"))
    predicted = forecast.predict_ridge(asked, models)
    mse = {r["AREA"]: r["mse"] for r in forecast.holdout_mse(predicted).collect()}
    assert mse["a"] < 200  # counts run from 60 to 270
    assert predicted.filter("yhat < 0").count() == 0


def test_ridge_predicts_what_its_numbers_say(spark, ridge):
    """The prediction expression equals the dot product done in numpy."""
    table, models = ridge
    row = table.filter("AREA = 'a'").orderBy("ds").select("*", forecast.ridge_inputs().alias("x")).first()
    m = models.filter("AREA = 'a'").first()
    z = (np.array(row["x"]) - np.array(m["center"])) / np.array(m["scale"])
    t = row["year"] * 12 + row["month"] - m["origin"]
    expected = (m["intercept"] + m["slope"] * t) * (1 + z @ np.array(m["weight"]))
    asked = spark.createDataFrame([("a", row["year"], row["month"], 5.0)], REQUEST)
    assert forecast.predict_ridge(asked, models).first()["yhat"] == pytest.approx(expected)


def test_ridge_refuses_a_missing_rate_or_area(spark, ridge):
    _, models = ridge
    with pytest.raises(PySparkException, match="no unemployment_rate"):
        forecast.predict_ridge(spark.createDataFrame([("a", 2030, 1, None)], REQUEST), models).collect()
    with pytest.raises(PySparkException, match="no model for area z"):
        forecast.predict_ridge(spark.createDataFrame([("z", 2030, 1, 5.0)], REQUEST), models).collect()


def ridge_by_hand(t, y, x):
    """The same model in one go: line, standardised inputs weighed by the trend, ridge."""
    slope, intercept = np.polyfit(t, y, 1)
    trend = intercept + slope * t
    level = np.sqrt(np.mean(trend ** 2))
    scale = np.where(x.std(axis=0) > 1e-9, x.std(axis=0), 1.0)
    u = (x - x.mean(axis=0)) / scale * (trend / level)[:, None]
    return np.linalg.solve(u.T @ u + np.eye(x.shape[1]), u.T @ ((y - trend) / level)), trend


def test_ridge_weights_equal_one_solve_over_all_rows(spark):
    """Also where the trend falls below 0, whose rows count like any other."""
    values = {"up": [30 + i + (i % 12) * 2 for i in range(50)],
              "down": [max(60 - 6 * i, 0) + (i % 3 == 0) * (i < 12) * 20 for i in range(40)],
              "flat": [0] * 12}
    table = forecast.split_series(features.with_rate(series(spark, **values), None))
    models = {r["AREA"]: r for r in forecast.fit_ridge(table).collect()}
    train = table.filter("not is_test").select(
        "AREA", "ds", "crime_count", forecast.ridge_inputs().alias("x")).orderBy("AREA", "ds").collect()
    below = {}
    for area in values:
        rows = [r for r in train if r["AREA"] == area]
        x = np.array([r["x"] for r in rows])
        want, trend = ridge_by_hand(np.arange(len(rows), dtype=float),
                                    np.array([r["crime_count"] for r in rows], float), x) \
            if area != "flat" else (np.zeros(35), np.zeros(len(rows)))
        assert models[area]["n_train"] == len(rows)
        assert np.allclose(models[area]["weight"], want, atol=1e-7)
        below[area] = int((trend <= 0).sum())
    assert below["down"] > 5


def test_gram_sums_do_not_depend_on_the_partitions(spark, ridge):
    table, _ = ridge
    train = forecast._train_rows(table)
    sums = [{(r["AREA"], r["i"], r["j"]): r["s"] for r in
             forecast.ridge_gram(train.repartition(n), forecast._moments(train)).collect()}
            for n in (1, 7)]
    assert len(sums[0]) == 2 * (35 * 36 // 2 + 35)
    assert sums[0].keys() == sums[1].keys()
    assert all(sums[0][k] == pytest.approx(sums[1][k], abs=1e-9) for k in sums[0])
