"""Registered queries: horizons, hierarchies, trends, substitutes and residuals."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelftide.operators import affinity, clusters, metrics, periods, residuals
from shelftide.plans import hierarchy, horizons
from shelftide.sources.retail import SPLIT_AT

from . import inputs
from .query_profile import ROW, _rounded


def _split():
    return F.lit(SPLIT_AT).cast("timestamp")


def horizon_metrics(spark, sf_dir):
    return _rounded(horizons.horizon_metrics(horizons.horizon_forecasts(inputs.sales(spark, sf_dir), _split())))


def horizon_weights(spark, sf_dir):
    """The direct models: one ridge regression per horizon."""
    past = horizons.origin_rows(inputs.sales(spark, sf_dir), targets=F.col("dt") < _split())
    return _rounded(horizons.direct_weights(past))


def _hierarchy(spark, sf_dir):
    return hierarchy.hierarchy_forecast(inputs.sales(spark, sf_dir), _split())


def hierarchy_forecast(spark, sf_dir):
    money = [(F.col(c).cast("double") / hierarchy.SCALE).alias(c) for c in ("actual", *hierarchy.METHODS)]
    return _hierarchy(spark, sf_dir).select("level", "store_id", "first_category_id", "product_id", "dt", *money)


def hierarchy_metrics(spark, sf_dir):
    return _rounded(hierarchy.hierarchy_metrics(_hierarchy(spark, sf_dir)), 9)


def substitutability(spark, sf_dir):
    return affinity.substitutability(inputs.sales(spark, sf_dir), min_support=2)


def cannibalization(spark, sf_dir):
    return _rounded(affinity.cannibalization(inputs.sales(spark, sf_dir)))


def _breaks(sales):
    """Breaks around every holiday: of different length by city, and one day around it for all."""
    days = sales.filter("holiday_flag = 1").select("city_id", F.date_trunc("day", "dt").alias("day")).distinct()
    city = F.make_dt_interval(F.col("city_id"))
    day = F.make_dt_interval(F.lit(1))
    return days.select("city_id", F.inline(F.array(
        F.struct((F.col("day") - city).alias("start"), (F.col("day") + day + day + city).alias("end")),
        F.struct((F.col("day") - day).alias("start"), (F.col("day") + day).alias("end")))))


def _on_breaks(spark, sf_dir):
    sales = inputs.sales(spark, sf_dir)
    return periods.in_periods(sales.select(*ROW, "city_id", "sale_amount"), _breaks(sales))


def school_calendar(spark, sf_dir):
    return _on_breaks(spark, sf_dir).select(*ROW, "school_break", "school_hours_since", "school_hours_left")


def school_effect(spark, sf_dir):
    return _rounded(periods.period_effect(_on_breaks(spark, sf_dir)), 9)


def _residuals(spark, sf_dir):
    return metrics.residuals(inputs.predictions(spark, sf_dir)).select(*ROW, "residual")


def residual_bias(spark, sf_dir):
    return _rounded(residuals.residual_bias(_residuals(spark, sf_dir)))


def cumulative_bias(spark, sf_dir):
    return _rounded(residuals.cumulative_bias(_residuals(spark, sf_dir)).drop("residual"))


def store_profiles(spark, sf_dir):
    """Profiles unfolded: one row per store and hour of the week."""
    made = clusters.week_profiles(inputs.sales(spark, sf_dir))
    return _rounded(made.select("store_id", "total", F.posexplode("profile").alias("slot", "share")), 9)


def store_clusters(spark, sf_dir):
    made = clusters.week_profiles(inputs.sales(spark, sf_dir))
    return clusters.fit_store_clusters(made).transform(made).select("store_id", "cluster", "distance")


QUERIES = {
    "store_profiles": store_profiles,
    "store_clusters": store_clusters,
    "substitutability": substitutability,
    "cannibalization": cannibalization,
    "school_calendar": school_calendar,
    "school_effect": school_effect,
    "residual_bias": residual_bias,
    "cumulative_bias": cumulative_bias,
    "hierarchy_forecast": hierarchy_forecast,
    "hierarchy_metrics": hierarchy_metrics,
    "horizon_metrics": horizon_metrics,
    "horizon_weights": horizon_weights,
}
