"""Date expressions: calendar dimensions, Sunday-start weeks, seasonality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import (SEASON_MID_FROM_DOY, SEASON_MID_MULT, SEASON_MID_TO_DOY,
                      SEASON_PEAK_FROM_DOY, SEASON_PEAK_MULT, SEASON_PEAK_TO_DOY)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def month_text(d) -> Column:
    """``yyyy-MM`` period label."""
    return F.date_format(_c(d), "yyyy-MM")


def quarter_text(d) -> Column:
    """``yyyyQn`` (pandas ``Period('Q')`` text: no hyphen)."""
    return F.concat(F.year(_c(d)).cast("string"), F.lit("Q"), F.quarter(_c(d)).cast("string"))


def day_name(d) -> Column:
    return F.date_format(_c(d), "EEEE")


def add_time_dimensions(df: DataFrame, date_col: str = "order_date") -> DataFrame:
    """year, month text, quarter text and English day name; null date -> nulls."""
    return df.withColumns({
        "order_year": F.year(F.col(date_col)),
        "order_month": month_text(date_col),
        "order_quarter": quarter_text(date_col),
        "day_of_week": day_name(date_col),
    })


def week_start_sunday(d) -> Column:
    """Floor a date to its week, weeks starting on Sunday (``dayofweek`` is 1 on Sunday)."""
    return F.date_sub(_c(d), F.dayofweek(_c(d)) - 1)


def seasonal_multiplier(d) -> Column:
    """1.55 in the holiday window (day of year >= 320 or <= 5), 1.25 mid-year (150..175), else 1.0."""
    doy = F.dayofyear(_c(d))
    return (F.when((doy >= SEASON_PEAK_FROM_DOY) | (doy <= SEASON_PEAK_TO_DOY), F.lit(SEASON_PEAK_MULT))
             .when(doy.between(SEASON_MID_FROM_DOY, SEASON_MID_TO_DOY), F.lit(SEASON_MID_MULT))
             .otherwise(F.lit(1.0)))


def epoch_days(d) -> Column:
    """Days since 1970-01-01 as a double (the numeric value of an R ``Date``)."""
    return F.datediff(_c(d), F.lit("1970-01-01").cast("date")).cast("double")
