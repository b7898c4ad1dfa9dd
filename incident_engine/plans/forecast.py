"""Monthly forecasts per area, from files to a horizon."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_engine.operators import features
from incident_engine.operators import forecast as op
from incident_engine.schemas import HOLDOUT_SHARE
from incident_engine.session import materialize
from incident_engine.sources.files import optional_csv, scan_csv_skip_long

RATE_COLUMNS = "year int, month int, AREA string, unemployment_rate double"


@dataclass(frozen=True)
class AreaForecast:
    """Feature table and one model per area; all tables are small and written once."""

    features: DataFrame
    models: DataFrame
    ridge: bool

    @classmethod
    def fit(cls, incidents: DataFrame, rate: DataFrame | None = None, ridge: bool = True,
            test_share: float = HOLDOUT_SHARE) -> AreaForecast:
        """Scan the incidents once, then fit.

        ``ridge`` takes seasonal waves and all regressors; otherwise a line
        times a month index is fitted, all in SQL.
        """
        table = features.area_month_features(features.clean_incidents(incidents), rate)
        split = materialize(op.split_series(table, test_share), "area-months")
        models = op.fit_ridge(split) if ridge else op.fit_trend_season(split)
        return cls(split, materialize(models, "area-models"), ridge)

    def predict(self, requests: DataFrame) -> DataFrame:
        """Add ``yhat`` to requests ``AREA, year, month`` (and the rate, for ridge)."""
        run = op.predict_ridge if self.ridge else op.predict_trend_season
        return run(requests, self.models)

    def horizon(self, start_year: int, start_month: int, months: int,
                areas: list[str] | DataFrame | None = None, rate: float | None = None) -> DataFrame:
        """Months ahead for each wanted area, with one assumed rate in percent."""
        asked = op.horizon(self.models, start_year, start_month, months, areas)
        return self.predict(asked.withColumn("unemployment_rate", F.lit(rate).cast("double")))

    def mse(self) -> DataFrame:
        """Mean squared error per area on the held-out months."""
        asked = self.features.select(
            "AREA", "ds", "year", "month", "unemployment_rate", "is_test",
            F.col("crime_count").alias("y"))
        return op.holdout_mse(self.predict(asked))


def forecast_from_files(spark: SparkSession, incidents_csv: str, rate_csv: str | None = None,
                        ridge: bool = True) -> AreaForecast:
    """Fit from a CSV table with a date and an area column, and an optional rate file."""
    rate = optional_csv(spark, rate_csv, RATE_COLUMNS)
    return AreaForecast.fit(scan_csv_skip_long(spark, incidents_csv), rate, ridge)
