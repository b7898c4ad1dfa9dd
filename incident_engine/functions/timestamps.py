"""Text to time, time to text, and calendar features.

Parsing never fails a job: text that does not fit its pattern becomes null,
also under ANSI mode.
"""

from __future__ import annotations

from collections.abc import Iterable
from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F

from incident_engine.functions.columns import ColumnLike, as_column
from incident_engine.schemas import (
    HOLIDAY_MONTHS,
    MONTH_TEXT,
    TEXT_TIMESTAMP,
    TWELVE_HOUR_TEXT,
)


def parse_iso(c: ColumnLike) -> Column:
    """ISO text such as ``2025-05-20T16:02:26.000``."""
    return F.try_to_timestamp(as_column(c))


def parse_month(c: ColumnLike) -> Column:
    """``yyyy-MM`` text to the first instant of the month."""
    return F.try_to_timestamp(as_column(c), F.lit(MONTH_TEXT))


def parse_12h(c: ColumnLike) -> Column:
    """``MM/dd/yyyy hh:mm:ss a`` text."""
    return F.try_to_timestamp(as_column(c), F.lit(TWELVE_HOUR_TEXT))


def parse_24h_marked(c: ColumnLike) -> Column:
    """24-hour text that also carries an AM/PM mark.

    The mark must be there but does not change the hour.
    """
    bare = F.regexp_extract(as_column(c), r"^(.*\S)\s+[AaPp][Mm]$", 1)
    return F.try_to_timestamp(bare, F.lit("M/d/yyyy H:m:s"))


# Date forms tried in turn: by the forecaster's cleaning step, and where a file
# may hold either of the other two.
FORECAST_DATE_FORMS = (parse_24h_marked, parse_iso)
FILE_DATE_FORMS = (parse_iso, parse_12h)


def parse_first(c: ColumnLike, forms: Iterable = FORECAST_DATE_FORMS) -> Column:
    """First form that reads the text wins; null when none does."""
    return F.coalesce(*[form(c) for form in forms])


def to_text(c: ColumnLike) -> Column:
    return F.date_format(as_column(c), TEXT_TIMESTAMP)


def month_start(c: ColumnLike) -> Column:
    return F.trunc(as_column(c), "month")


def next_month(c: ColumnLike) -> Column:
    """First day of the month after the one that holds ``c``."""
    return F.add_months(month_start(c), 1)


def previous_month(c: ColumnLike) -> Column:
    return F.add_months(month_start(c), -1)


def first_of_month(year: ColumnLike, month: ColumnLike) -> Column:
    return F.make_date(as_column(year).cast("int"), as_column(month).cast("int"), F.lit(1))


def days_in_month(c: ColumnLike) -> Column:
    return F.dayofmonth(F.last_day(as_column(c)))


def on_circle(value: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of ``value`` on a circle of ``period`` steps."""
    angle = value * F.lit(2 * pi) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def calendar_features(ds: ColumnLike) -> dict[str, Column]:
    """Calendar regressors of a month, given its first day."""
    day = as_column(ds)
    month_sin, month_cos = on_circle(F.month(day), 12)
    weekday = F.weekday(day)
    weekday_sin, weekday_cos = on_circle(weekday, 7)
    return {
        "month": F.month(day),
        "year": F.year(day),
        "days_in_month": days_in_month(day),
        "month_sin": month_sin,
        "month_cos": month_cos,
        "day_of_week": weekday,
        "day_of_week_sin": weekday_sin,
        "day_of_week_cos": weekday_cos,
        "is_holiday": F.month(day).isin(*HOLIDAY_MONTHS).cast("int"),
    }
