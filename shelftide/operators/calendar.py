"""Calendar features. Weekdays count from Monday = 0."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SEASONAL_PERIODS
from ..functions.columns import cycle, flag, seconds, weekday_monday0


def calendar_parts(df: DataFrame, dt: str = "dt") -> DataFrame:
    return df.withColumns({
        "hour": F.hour(dt).cast("int"),
        "day_of_week": weekday_monday0(dt),
        "day_of_month": F.dayofmonth(dt).cast("int"),
        "month": F.month(dt).cast("int"),
        "quarter": F.quarter(dt).cast("int"),
        "week_of_year": F.weekofyear(dt).cast("int"),
    })


def time_parts(df: DataFrame, dt: str = "dt") -> DataFrame:
    """The three parts the models use."""
    return df.withColumns({
        "hour": F.hour(dt).cast("int"),
        "day_of_week": weekday_monday0(dt),
        "month": F.month(dt).cast("int"),
    })


def cyclical(df: DataFrame, weekday_prefix: str = "day_of_week", month_from_zero: bool = False) -> DataFrame:
    """Sine and cosine of hour, weekday and month; needs the calendar parts."""
    month = F.col("month") - 1 if month_from_zero else F.col("month")
    new = {}
    for prefix, value, period in (
        ("hour", F.col("hour"), 24), (weekday_prefix, F.col("day_of_week"), 7), ("month", month, 12)
    ):
        new[f"{prefix}_sin"], new[f"{prefix}_cos"] = cycle(value, period)
    return df.withColumns(new)


def weekend_flags(df: DataFrame) -> DataFrame:
    dow = F.col("day_of_week")
    return df.withColumns({"is_weekend": flag(dow >= 5), "is_weekday": flag(dow < 5)})


def day_parts(df: DataFrame) -> DataFrame:
    hour = F.col("hour")
    return df.withColumns({
        "is_morning_rush": flag(hour.between(7, 9)),
        "is_lunch_time": flag(hour.between(11, 14)),
        "is_evening_rush": flag(hour.between(17, 20)),
        "is_late_night": flag((hour >= 22) | (hour <= 5)),
    })


def trend(df: DataFrame, dt: str = "dt") -> DataFrame:
    """Whole days and hours since the first timestamp of the table."""
    since = seconds(dt) - df.agg(seconds(F.min(dt)).alias("s")).scalar()
    return df.withColumns({
        "days_since_start": F.floor(since / 86400).cast("long"),
        "hours_since_start": since / 3600,
    })


def time_interactions(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "hour_dow_interaction": F.col("hour") * F.col("day_of_week"),
        "hour_month_interaction": F.col("hour") * F.col("month"),
    })


def interactions(df: DataFrame) -> DataFrame:
    """Weather, promotion and stock crossed with time; needs hour, weekend and evening flags."""
    hour, weekend = F.col("hour"), F.col("is_weekend")
    return df.withColumns({
        "temp_hour_interaction": F.col("avg_temperature") * hour,
        "rain_weekend_interaction": F.col("precpt") * weekend,
        "discount_weekend": F.col("discount") * weekend,
        "discount_evening": F.col("discount") * F.col("is_evening_rush"),
        "stock_hour_interaction": F.col("hours_stock_status") * hour,
    })


def seasonal_terms(df: DataFrame, periods: Sequence[int] = SEASONAL_PERIODS, dt: str = "dt") -> DataFrame:
    """Sine and cosine of the hour over each period; a period above 24 is never completed."""
    new = {}
    for p in periods:
        new[f"sin_{p}"], new[f"cos_{p}"] = cycle(F.hour(dt), p)
    return df.withColumns(new)
