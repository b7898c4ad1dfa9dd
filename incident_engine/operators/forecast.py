"""Monthly forecasts per area.

A series is ``AREA, ds, crime_count`` (plus regressors for the ridge model);
its length is bounded by the calendar. Models are rows of a table, so a
prediction is a join, and each area is fitted where Spark placed it.
"""

from __future__ import annotations

from math import pi

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from incident_engine.functions import scores, timestamps
from incident_engine.operators.features import require_columns
from incident_engine.schemas import HOLDOUT_SHARE

# Regressors of the ridge model and the orders of its seasonal terms.
REGRESSORS = [
    "month", "year", "days_in_month", "month_sin", "month_cos",
    "day_of_week_sin", "day_of_week_cos", "is_holiday", "unemployment_rate",
]
YEARLY_ORDER = 10
WEEKLY_ORDER = 3
RIDGE_PENALTY = 1.0
#: A spread below this is none.
FLAT = 1e-9


def month_number(ds: Column | str) -> Column:
    """Months on one running scale, so that gaps in a series keep their length."""
    return F.year(ds) * 12 + F.month(ds)


def split_series(series: DataFrame, test_share: float = HOLDOUT_SHARE) -> DataFrame:
    """Mark the last ``ceil(share * n)`` months of each area as test rows.

    Areas with two months or fewer are left out. Adds ``rn, n, is_test``.
    """
    area = Window.partitionBy("AREA")
    counted = series.withColumns({
        "rn": F.row_number().over(area.orderBy("ds")),
        "n": F.count(F.lit(1)).over(area),
    })
    held_out = F.ceil(F.col("n") * F.lit(test_share))
    return counted.filter(F.col("n") > 2).withColumn(
        "is_test", F.col("rn") > F.col("n") - held_out)


def _trend_season_columns(split: DataFrame) -> DataFrame:
    """Fit by windows over the area: one shuffle, no join back."""
    area = Window.partitionBy("AREA")
    train_y = F.when(~F.col("is_test"), F.col("crime_count").cast("double"))
    fitted = split.withColumn("origin", F.min(month_number("ds")).over(area))
    fitted = fitted.withColumn("t", (month_number("ds") - F.col("origin")).cast("double"))
    fitted = fitted.withColumns({
        "slope": F.regr_slope(train_y, F.col("t")).over(area),
        "intercept": F.regr_intercept(train_y, F.col("t")).over(area),
    })
    trend = F.col("intercept") + F.col("slope") * F.col("t")
    same_month = Window.partitionBy("AREA", F.month("ds"))
    return fitted.withColumns({
        "trend": trend,
        "season": F.avg(F.try_divide(train_y, trend)).over(same_month),
    })


def _trend_times_season(trend: Column, season: Column) -> Column:
    return scores.at_least_zero(trend * F.coalesce(season, F.lit(1.0)))


def fit_predict_trend_season(split: DataFrame) -> DataFrame:
    """Trend times month index on every row of the series: ``AREA, ds, y, yhat, is_test``."""
    return _trend_season_columns(split).select(
        "AREA", "ds", F.col("crime_count").alias("y"),
        _trend_times_season(F.col("trend"), F.col("season")).alias("yhat"), "is_test",
    )


def fit_trend_season(split: DataFrame) -> DataFrame:
    """One model row per area: line, origin and up to twelve month indices."""
    season = F.struct(F.month("ds").alias("month"), F.col("season").alias("index"))
    return _trend_season_columns(split).groupBy("AREA").agg(
        F.first("origin").alias("origin"),
        F.first("slope").alias("slope"),
        F.first("intercept").alias("intercept"),
        F.map_from_entries(
            F.collect_set(F.when(F.col("season").isNotNull(), season))).alias("season"),
    )


def _or_error(known: Column, value: Column, message: Column) -> Column:
    """``value``, or a failed job where ``known`` is null."""
    return F.when(known.isNull(), F.raise_error(message).cast("double")).otherwise(value)


def _answer(requests: DataFrame, joined: DataFrame, yhat: Column) -> DataFrame:
    """Requests with their prediction; an area without a model is an error."""
    no_model = F.concat(F.lit("no model for area "), F.col("AREA"))
    return joined.select(*requests.columns, _or_error(F.col("origin"), yhat, no_model).alias("yhat"))


def predict_trend_season(requests: DataFrame, models: DataFrame) -> DataFrame:
    """Add ``yhat`` to requests ``AREA, year, month``."""
    require_columns(requests, ["AREA", "year", "month"])
    t = F.col("year") * 12 + F.col("month") - F.col("origin")
    trend = F.col("intercept") + F.col("slope") * t
    season = F.col("season")[F.col("month").cast("int")]
    joined = requests.join(models, "AREA", "left")
    return _answer(requests, joined, _trend_times_season(trend, season))


def horizon(models: DataFrame, start_year: int, start_month: int, months: int,
            areas: list[str] | DataFrame | None = None) -> DataFrame:
    """Requests for ``months`` months from the start, for each area that has a model."""
    known = models.select("AREA")
    if isinstance(areas, list):
        known = known.filter(F.col("AREA").isin(areas))
    elif areas is not None:
        known = known.join(areas.select("AREA"), "AREA", "left_semi")
    start = F.make_date(F.lit(start_year), F.lit(start_month), F.lit(1))
    steps = F.sequence(start, F.add_months(start, months - 1), F.expr("interval 1 month"))
    return known.select("AREA", F.explode(steps).alias("ds")).select(
        "AREA", "ds", F.year("ds").alias("year"), F.month("ds").alias("month"))


def holdout_mse(predicted: DataFrame) -> DataFrame:
    """Mean squared error per area over the test rows."""
    error = F.pow(F.col("y") - F.col("yhat"), F.lit(2.0))
    return predicted.filter("is_test").groupBy("AREA").agg(F.avg(error).alias("mse"))


def ridge_inputs(ds: str = "ds") -> Column:
    """Design row: yearly and weekly Fourier terms, then the regressors."""
    day = F.datediff(F.col(ds), F.lit("1970-01-01").cast("date")).cast("double")
    waves = [(365.25, k) for k in range(1, YEARLY_ORDER + 1)]
    waves += [(7.0, k) for k in range(1, WEEKLY_ORDER + 1)]
    terms = [f(day * F.lit(2 * pi * k / period)) for period, k in waves for f in (F.sin, F.cos)]
    return F.array(*terms, *[F.col(name).cast("double") for name in REGRESSORS])


def _train_rows(split_features: DataFrame) -> DataFrame:
    """Training rows with the line through them: ``AREA, origin, t, y, x, slope, intercept, trend,
    level``. ``level`` is the root of the mean square of the trend, the unit of all that follows."""
    require_columns(split_features, ["AREA", "ds", "crime_count", "is_test", *REGRESSORS])
    area = Window.partitionBy("AREA")
    origin = F.min(month_number("ds")).over(area)
    train = split_features.select(
        "AREA", origin.alias("origin"), (month_number("ds") - origin).cast("double").alias("t"),
        F.col("crime_count").cast("double").alias("y"), ridge_inputs().alias("x"), "is_test",
    ).filter(~F.col("is_test")).drop("is_test")
    # one point has no slope; its line is flat
    slope = F.coalesce(F.regr_slope("y", "t").over(area), F.lit(0.0))
    train = train.withColumns({"slope": slope, "intercept": F.coalesce(
        F.regr_intercept("y", "t").over(area), F.avg("y").over(area))})
    train = train.withColumn("trend", F.col("intercept") + F.col("slope") * F.col("t"))
    level = F.sqrt(F.avg(F.col("trend") * F.col("trend")).over(area))
    return train.withColumn("level", F.when(level > FLAT, level).otherwise(1.0))


def _moments(train: DataFrame) -> DataFrame:
    """``AREA, center, scale``: mean and spread of each input, by sums over exploded inputs."""
    cells = train.select("AREA", F.posexplode("x").alias("i", "v"))
    each = cells.groupBy("AREA", "i").agg(
        F.avg("v").alias("center"), F.stddev_pop("v").alias("scale"))
    listed = each.groupBy("AREA").agg(F.array_sort(F.collect_list(F.struct(
        "i", "center", F.when(F.col("scale") > FLAT, F.col("scale")).otherwise(1.0).alias("scale"),
    ))).alias("each"))
    return listed.select("AREA", F.col("each.center").alias("center"), F.col("each.scale").alias("scale"))


def ridge_gram(train: DataFrame, moments: DataFrame) -> DataFrame:
    """Normal equations as sums: ``AREA, i, j, s`` with ``s`` the sum of products of inputs ``i`` and
    ``j``, i <= j; ``j`` = number of inputs stands for the target.

    Inputs are standardised and weighed by the trend, the target is the distance from the trend,
    both in units of the level; so a row whose trend is 0 or below counts like any other. Sums are
    combined in every task before the shuffle, however many rows an area has.
    """
    share = F.col("trend") / F.col("level")
    z = F.zip_with(F.zip_with("x", "center", lambda a, c: a - c), "scale", lambda d, s: d / s)
    row = train.join(moments, "AREA").select(
        "AREA", F.concat(F.transform(z, lambda v: v * share),
                         F.array((F.col("y") - F.col("trend")) / F.col("level"))).alias("u"))
    products = F.expr("""flatten(transform(slice(u, 1, size(u) - 1), (a, i) ->
        transform(slice(u, i + 1, size(u) - i), (b, k) ->
            named_struct('i', i, 'j', i + k, 'p', a * b))))""")
    return row.select("AREA", F.inline(products)).groupBy("AREA", "i", "j").agg(
        F.sum("p").alias("s"))


def _solve(sums: pd.DataFrame) -> pd.DataFrame:
    """Weights of one area from its sums, whose number depends on the inputs alone."""
    size = len(REGRESSORS) + 2 * (YEARLY_ORDER + WEEKLY_ORDER)
    full = np.zeros((size + 1, size + 1))
    full[sums["i"], sums["j"]] = sums["s"]
    full[sums["j"], sums["i"]] = sums["s"]
    gram, target = full[:size, :size], full[:size, size]
    weight = np.linalg.solve(gram + RIDGE_PENALTY * np.eye(size), target)
    return pd.DataFrame({"AREA": [sums["AREA"].iloc[0]], "weight": [weight]})


def fit_ridge(split_features: DataFrame) -> DataFrame:
    """One ridge model row per area, from the training rows of a split feature table:
    ``AREA, origin, n_train, slope, intercept, center, scale, weight``."""
    train = _train_rows(split_features)
    moments = _moments(train)
    weights = ridge_gram(train, moments).groupBy("AREA").applyInPandas(
        _solve, "AREA string, weight array<double>")
    lines = train.groupBy("AREA").agg(
        F.first("origin").cast("int").alias("origin"), F.count(F.lit(1)).cast("int").alias("n_train"),
        F.first("slope").alias("slope"), F.first("intercept").alias("intercept"))
    return lines.join(moments, "AREA").join(weights, "AREA")


def predict_ridge(requests: DataFrame, models: DataFrame) -> DataFrame:
    """Add ``yhat`` to requests ``AREA, year, month, unemployment_rate``.

    A missing rate is an error rather than a silent null.
    """
    require_columns(requests, ["AREA", "year", "month", "unemployment_rate"])
    ready = requests.withColumn("ds", timestamps.first_of_month("year", "month"))
    ready = ready.withColumns(timestamps.calendar_features("ds"))
    joined = ready.select(*requests.columns, ridge_inputs().alias("x")).join(models, "AREA", "left")
    scaled = F.zip_with(
        F.zip_with("x", "center", lambda a, c: a - c), "scale", lambda d, s: d / s)
    deviation = F.aggregate(
        F.zip_with(scaled, "weight", lambda z, w: z * w), F.lit(0.0), lambda acc, v: acc + v)
    t = F.col("year") * 12 + F.col("month") - F.col("origin")
    trend = F.col("intercept") + F.col("slope") * t
    yhat = _or_error(F.col("unemployment_rate"), scores.at_least_zero(trend * (1 + deviation)),
                     F.lit("a request has no unemployment_rate"))
    return _answer(requests, joined, yhat)
