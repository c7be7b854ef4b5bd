"""Registered queries: calendar, binned, window and group features."""

from __future__ import annotations

from shelftide.operators import bins, calendar, groups, windows

from . import inputs
from .query_profile import ROW, _rounded

Y = "sale_amount"
MEASURES = ["discount", "avg_temperature", "precpt"]


def _new(fn, keep=(), digits=9, first=None, nudge=None):
    """Keys, the kept columns and whatever ``fn`` adds, rounded."""

    def run(spark, sf_dir):
        df = inputs.sales(spark, sf_dir)
        df = first(df) if first else df
        out = fn(df)
        added = [c for c in out.columns if c not in df.columns]
        return _rounded(out.select(*ROW, *keep, *added), digits, nudge)

    return run


def _parts(df):
    return calendar.day_parts(calendar.weekend_flags(calendar.calendar_parts(df)))


def _binned(df):
    return bins.precip_category(bins.temp_category(_parts(df)))


def _series(df):
    """Only the columns the window features read, so nothing else is shuffled."""
    return df.select(*ROW, Y)


def fill_features(spark, sf_dir):
    lagged = windows.lag_features(_series(inputs.sales(spark, sf_dir)), (1, 168))
    return bins.fill_features(lagged, [f"{Y}_lag_1", f"{Y}_lag_168", "not_there"], 0.0)


def fill_all_zero(spark, sf_dir):
    rolled = windows.rolling_prior(_series(inputs.sales(spark, sf_dir)), (6,), ("mean", "std"))
    return _rounded(bins.fill_all_zero(rolled, keep=["store_id", "product_id"]), 6)


# A mean of prices may lie exactly between two rounded values.
NUDGE = {"mean": 1e-9}


def _incl(stat):
    return _new(lambda d: windows.rolling_incl(d, stats=(stat,)), digits=6, first=_series, nudge=NUDGE.get(stat))


def _prior(stat):
    return _new(lambda d: windows.rolling_prior(d, stats=(stat,)), digits=6, first=_series, nudge=NUDGE.get(stat))


QUERIES = {
    "calendar_parts": _new(calendar.calendar_parts),
    "cyclical": _new(calendar.cyclical, first=calendar.calendar_parts),
    "cyclical_month0": _new(lambda d: calendar.cyclical(d, "dow", True), first=calendar.time_parts),
    "weekend_flags": _new(calendar.weekend_flags, first=calendar.calendar_parts),
    "day_parts": _new(calendar.day_parts, first=calendar.calendar_parts),
    "trend": _new(calendar.trend),
    "time_interactions": _new(calendar.time_interactions, first=calendar.time_parts),
    "interactions": _new(calendar.interactions, first=_parts),
    "seasonal_terms": _new(calendar.seasonal_terms),
    "temp_category": _new(bins.temp_category),
    "precip_category": _new(bins.precip_category),
    "discount_category": _new(bins.discount_category),
    "hot_weekend_afternoon": _new(bins.hot_weekend_afternoon, first=_binned),
    "rainy_morning_discount": _new(bins.rainy_morning_discount, first=_binned),
    "fill_features": fill_features,
    "fill_all_zero": fill_all_zero,
    "lag_features": _new(windows.lag_features, first=_series),
    "stockout_lags": _new(windows.stockout_lags, first=lambda d: d.select(*ROW, "hours_stock_status")),
    "rolling_incl_mean": _incl("mean"),
    "rolling_incl_std": _incl("std"),
    "rolling_incl_max": _incl("max"),
    "rolling_incl_median": _incl("median"),
    "rolling_prior_mean": _prior("mean"),
    "rolling_prior_std": _prior("std"),
    "rolling_prior_min": _prior("min"),
    "rolling_prior_max": _prior("max"),
    "rolling_prior_q25": _prior("q25"),
    "rolling_prior_q75": _prior("q75"),
    "rolling_trend": _new(windows.rolling_trend, first=_series),
    "rolling_trend_incl": _new(lambda d: windows.rolling_trend(d, prior=False), first=_series),
    "ewm_prior": _new(windows.ewm_prior, digits=6, first=_series),
    "holiday_adjacent": _new(windows.holiday_adjacent, first=lambda d: d.select(*ROW, "holiday_flag")),
    "weather_change": _new(windows.weather_change, first=lambda d: d.select(*ROW, "avg_temperature", "precpt")),
    "discount_change": _new(windows.discount_change, first=lambda d: d.select(*ROW, "discount")),
    "sales_rank": _new(windows.sales_rank, first=lambda d: d.select(*ROW, "first_category_id", Y)),
    "product_velocity": _new(windows.product_velocity, first=_series),
    "store_stats": _new(groups.store_stats, digits=2, first=_series),
    "product_stats": _new(groups.product_stats, digits=2, first=_series),
    "city_stats": _new(groups.city_stats, digits=2, first=lambda d: d.select(*ROW, "city_id", Y, "hours_stock_status")),
    "store_features": _new(groups.store_features, first=lambda d: d.select(*ROW, Y, "hours_stock_status")),
    "avg_discount": _new(groups.avg_discount, first=lambda d: d.select(*ROW, "first_category_id", "discount")),
    "product_stage": _new(groups.product_stage, first=_series),
    "category_spillover": _new(groups.category_spillover, first=lambda d: d.select(*ROW, "first_category_id", Y)),
    "complementary_count": _new(groups.complementary_count, first=_series),
    "city_total": _new(groups.city_total, first=lambda d: d.select(*ROW, "city_id", Y)),
}
