"""Cleaning and the monthly feature table per area."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from incident_engine.functions import text, timestamps
from incident_engine.schemas import DEFAULT_RATE


def find_column(df: DataFrame, word: str) -> str:
    """First column whose name holds ``word``, whatever its case."""
    for name in df.columns:
        if word in name.lower():
            return name
    raise ValueError(f"no column name holds {word!r}: {df.columns}")


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def clean_incidents(df: DataFrame, date_column: str | None = None,
                    area_column: str | None = None) -> DataFrame:
    """Add ``AREA, occurred, year, month`` and drop rows without area or month."""
    date_column = date_column or find_column(df, "date")
    area_column = area_column or find_column(df, "area")
    is_text = isinstance(df.schema[date_column].dataType, StringType)
    date = F.col(f"`{date_column}`")
    occurred = timestamps.parse_first(date) if is_text else date
    area = text.strip_float_suffix(F.col(f"`{area_column}`"))
    out = df.withColumns({"__occurred": occurred, "__area": area})
    out = out.drop("occurred", "year", "month", "AREA").select(
        "*", F.col("__area").alias("AREA"), F.col("__occurred").alias("occurred"),
        F.year("__occurred").alias("year"), F.month("__occurred").alias("month"),
    ).drop("__area", "__occurred")
    require_columns(out, ["AREA", "month"])
    return out.dropna(subset=["AREA", "month"]).filter(F.col("AREA") != "nan")


def area_month_counts(clean: DataFrame) -> DataFrame:
    return clean.groupBy("AREA", "year", "month").agg(F.count(F.lit(1)).alias("crime_count"))


def with_rate(counts: DataFrame, rate: DataFrame | None, default: float = DEFAULT_RATE
              ) -> DataFrame:
    """Outside rate (percent) by area and month; the default where there is none.

    Both sides hold one row per area and month or close to it, so Spark picks
    the join; duplicate rate keys repeat rows. The rate's keys take the types
    of the counts, which then stay where their aggregation left them.
    """
    if rate is None:
        return counts.withColumn("unemployment_rate", F.lit(default))
    keys = ["AREA", "year", "month"]
    typed = rate.select(*[F.col(k).cast(counts.schema[k].dataType).alias(k) for k in keys],
                        "unemployment_rate")
    joined = counts.join(typed, keys, "left")
    filled = F.coalesce("unemployment_rate", F.lit(default))
    return joined.withColumn("unemployment_rate", filled)


def with_calendar(counts: DataFrame) -> DataFrame:
    """Add ``ds`` (first of month) and the calendar regressors."""
    df = counts.withColumn("ds", timestamps.first_of_month("year", "month"))
    extra: dict[str, Column] = timestamps.calendar_features("ds")
    return df.withColumns({k: v for k, v in extra.items() if k not in ("year", "month")})


def area_month_features(clean: DataFrame, rate: DataFrame | None = None) -> DataFrame:
    return with_rate(with_calendar(area_month_counts(clean)), rate)
