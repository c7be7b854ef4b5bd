"""Feature pipelines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import LONG_LAGS, MODEL_LAGS, SERIES_KEYS, SHORT_LAGS, STAGE_BINS, WINDOWS
from ..functions.columns import binned, exact_avg, exact_sum
from ..operators import bins, calendar, groups, windows
from ..operators.series import HOT_ROWS, attach, distinct_keys, over_series

Y = "sale_amount"
CYCLE_FEATURES = ("hour_sin", "hour_cos", "dow_sin", "dow_cos")


def features_basic(
    df: DataFrame,
    *,
    categorical: bool = False,
    lags: Sequence[int] | None = None,
    rolling: Sequence[int] | None = None,
) -> DataFrame:
    """Calendar features and interactions; the heavier steps are optional."""
    out = (
        df.transform(calendar.calendar_parts)
        .transform(calendar.cyclical)
        .transform(calendar.weekend_flags)
        .transform(calendar.day_parts)
        .transform(calendar.trend)
    )
    if categorical:
        out = groups.categorical_features(out)
    steps, reach = [], 0
    if lags:
        steps.append(windows.lag_columns(Y, lags, "hours_stock_status"))
        reach = max(reach, *lags)
    if rolling:
        stats = ("mean", "std", "max", "median")
        steps.append(windows.rolling_columns(Y, rolling, stats, Y + "_rolling_{stat}_{w}", prior=False))
        reach = max(reach, *rolling)
    if steps:
        out = over_series(out, windows.chain(*steps), SERIES_KEYS, lookback=reach)
    return calendar.interactions(out)


def features_all(df: DataFrame) -> DataFrame:
    """The basic pipeline with every optional step."""
    return features_basic(df, categorical=True, lags=SHORT_LAGS, rolling=WINDOWS)


def lag_rolling(
    df: DataFrame, lags: Sequence[int] = LONG_LAGS, sizes: Sequence[int] = WINDOWS, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Lags, statistics of prior rows and exponentially weighted means, with gaps filled by 0."""
    stats = ("mean", "std", "min", "max", "q25", "q75")
    steps = windows.chain(
        windows.lag_columns(Y, lags),
        windows.rolling_columns(Y, sizes, stats, Y + "_roll_{stat}_{w}", prior=True),
    )
    out = over_series(df, steps, SERIES_KEYS, lookback=max(*lags, *sizes) + 1, hot_rows=hot_rows)
    out = windows.ewm_prior(out, sizes, hot_rows=min(hot_rows, windows.PANDAS_ROWS))
    return bins.fill_features(out, [c for c in out.columns if c not in df.columns], 0.0)


def features_full(df: DataFrame, *, discount_scale: float = 100.0, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Time, weather, promotion, store, product, cross and interaction features.

    Statistics with the same key come from one aggregate. The windows come first, on
    rows as narrow as they were read, and the one over products before those over
    series: rows placed by product are already placed for its series, so both use
    one shuffle.
    """
    category = "first_category_id"
    changes = {"avg_temperature": "temp_change", "precpt": "precip_change", "discount": "discount_change"}
    out = windows.product_velocity(df, hot_rows=hot_rows)
    out = over_series(
        out, windows.chain(windows.holiday_columns(), windows.change_columns(changes)),
        SERIES_KEYS, lookback=1, lookahead=1, hot_rows=hot_rows, sized_by=df,
    )
    out = windows.sales_rank(out, source=df)

    n_store, n_category, n_product, n_city, n_hour = distinct_keys(
        df, ["store_id"], [category], ["product_id"], ["city_id"], ["store_id", "dt"]
    )
    by_store = df.groupBy("store_id").agg(
        exact_avg("discount").alias("avg_discount_store"), *groups.store_feature_columns()
    )
    by_category = df.groupBy(category).agg(
        exact_avg("discount").alias("avg_discount_category"), exact_sum(Y).alias("category_sales_sum")
    )
    by_product = df.groupBy("product_id").agg(binned(exact_avg(Y), STAGE_BINS).alias("product_stage"))
    by_city = df.groupBy("city_id").agg(exact_sum(Y).alias("city_total_sales"))
    by_hour = df.groupBy("store_id", "dt").agg((F.count_distinct("product_id") - 1).alias("comp_products_count"))
    out = attach(out, by_store, ["store_id"], n_store)
    out = attach(out, by_category, [category], n_category)
    out = attach(out, by_product, ["product_id"], n_product)
    out = attach(out, by_city, ["city_id"], n_city)
    out = attach(out, by_hour, ["store_id", "dt"], n_hour, spread=True)
    return (
        out.transform(calendar.time_parts)
        .transform(lambda d: calendar.cyclical(d, "dow"))
        .transform(calendar.time_interactions)
        .transform(bins.temp_category)
        .transform(bins.precip_category)
        .transform(lambda d: bins.discount_category(d, scale=discount_scale))
        .transform(bins.hot_weekend_afternoon)
        .transform(bins.rainy_morning_discount)
    )


def model_feature_names(lags: Sequence[int] = MODEL_LAGS) -> list[str]:
    return [*CYCLE_FEATURES, *[f"{Y}_lag_{k}" for k in lags]]


def features_model(
    df: DataFrame, lags: Sequence[int] = MODEL_LAGS, *, history: DataFrame | None = None,
    fill: float = 0.0, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Cyclic time features and lags for the models.

    Lags start anew in ``df`` unless ``history`` gives the rows before it; then only
    the last rows of each series are taken from there.
    """
    names = [f"{Y}_lag_{k}" for k in lags]
    if history is None:
        out = windows.lag_features(df, lags, hot_rows=hot_rows)
    else:
        newest = Window.partitionBy(*SERIES_KEYS).orderBy(F.desc("dt"))
        tail = history.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= max(lags)).drop("_rank")
        both = tail.select(*df.columns).withColumn("_past", F.lit(True)).unionByName(df.withColumn("_past", F.lit(False)))
        out = windows.lag_features(both, lags, hot_rows=hot_rows).filter(~F.col("_past")).drop("_past")
    out = calendar.cyclical(calendar.time_parts(out), "dow", month_from_zero=True)
    return bins.fill_features(out, names, fill)
