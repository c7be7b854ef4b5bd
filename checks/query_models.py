"""Registered queries: input preparation, naive forecasters and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelftide.forecast import naive
from shelftide.operators import metrics, prep, windows

from . import inputs
from .query_profile import ROW, _rounded

Y = "sale_amount"
FEATURES = ["avg_temperature", f"{Y}_lag_1", f"{Y}_lag_168"]


def _feature_rows(spark, sf_dir):
    df = inputs.sales(spark, sf_dir).select(*ROW, "avg_temperature", Y)
    return windows.lag_features(df, (1, 168)).select(*ROW, *FEATURES)


def _fitted_on_train(fn, digits=6):
    def run(spark, sf_dir):
        df = _feature_rows(spark, sf_dir)
        train = df.filter(F.col("dt") < F.lit("2024-01-24").cast("timestamp"))
        return _rounded(fn(train, df), digits)

    return run


def finite_clean(spark, sf_dir):
    hour = F.hour("dt")
    odd = (
        F.when(hour == 0, F.lit(float("nan"))).when(hour == 1, F.lit(float("inf")))
        .when(hour == 2, F.lit(float("-inf"))).when(hour == 3, F.lit(None).cast("double")).otherwise(F.col(Y))
    )
    return prep.finite_clean(inputs.sales(spark, sf_dir).select(*ROW, odd.alias("x")), ["x"])


def train_val_split(spark, sf_dir):
    train, held = prep.train_val_split(inputs.sales(spark, sf_dir).select(*ROW))
    return train.withColumn("part", F.lit("train")).unionByName(held.withColumn("part", F.lit("validation")))


def clip_nonneg(spark, sf_dir):
    scored = inputs.predictions(spark, sf_dir).select(*ROW, (F.col("prediction") - 5).alias("prediction"))
    return _rounded(prep.clip_nonneg(scored))


NAIVE = {
    "naive_last": lambda: naive.Naive("last"),
    "naive_seasonal_mean": lambda: naive.Naive("seasonal", 24),
    "naive_mean": lambda: naive.Naive("mean"),
    "naive_drift": lambda: naive.Naive("drift"),
    "seasonal_profile": naive.SeasonalProfile,
    "simple_naive": naive.SimpleNaive,
    "seasonal_naive": naive.SeasonalNaive,
    "moving_average": naive.MovingAverage,
}


def _forecast(forecaster, rows):
    def run(spark, sf_dir):
        model = forecaster().fit(rows(spark, sf_dir))
        future = inputs.evaluation(spark, sf_dir).select(*ROW)
        return _rounded(model.transform(future))

    return run


def _metric(name):
    # The clamped percentage error is of the order of 1e10 where sales are zero.
    digits = 0 if name == "mape_clamped" else 6
    return lambda spark, d: _rounded(metrics.single_metric(inputs.predictions(spark, d), name), digits)


def _shown(df):
    """Metric columns rounded for the comparison."""
    digits = {"mape": 0}
    kinds = dict(df.dtypes)
    return df.select(*[
        F.round(c, digits.get(c, 6)).alias(c) if kinds[c] == "double" else F.col(c) for c in df.columns
    ])


def mase(spark, sf_dir):
    return _rounded(metrics.mase(inputs.predictions(spark, sf_dir), inputs.train(spark, sf_dir), 24))


def all_metrics(spark, sf_dir):
    return _shown(metrics.all_metrics(inputs.predictions(spark, sf_dir), inputs.train(spark, sf_dir), 24))


def compare_models(spark, sf_dir):
    past, future = inputs.train(spark, sf_dir), inputs.evaluation(spark, sf_dir)
    models = [naive.Naive("last"), naive.Naive("mean"), naive.SeasonalNaive()]
    scored = None
    for forecaster in models:
        model = forecaster.fit(past)
        part = model.transform(future).select(F.lit(model.name).alias("model"), Y, "prediction")
        scored = part if scored is None else scored.unionByName(part)
    return _rounded(metrics.compare_models(scored))


def _by(column):
    return lambda spark, d: _shown(metrics.metrics_by_group(inputs.predictions(spark, d), [column]))


def train_r2(spark, sf_dir):
    return _rounded(metrics.r2(inputs.predictions(spark, sf_dir)))


QUERIES = {
    "impute_median": _fitted_on_train(lambda train, df: prep.impute_median(train, df, FEATURES)),
    "impute_constant": _fitted_on_train(lambda train, df: prep.impute_constant(df, FEATURES)),
    "standard_scale": _fitted_on_train(lambda train, df: prep.scale(train, df, FEATURES)),
    "robust_scale": _fitted_on_train(lambda train, df: prep.scale(train, df, FEATURES, "robust")),
    "finite_clean": finite_clean,
    "train_val_split": train_val_split,
    "clip_nonneg": clip_nonneg,
    # Fitted without one series, so that its forecast takes the default, and on all series.
    **{name: _forecast(f, inputs.seen_train) for name, f in NAIVE.items()},
    **{f"{name}_all": _forecast(f, inputs.train) for name, f in NAIVE.items()},
    **{name: _metric(name) for name in metrics.SINGLE},
    "mase": mase,
    "all_metrics": all_metrics,
    "metrics_by_group": lambda spark, d: _shown(
        metrics.metrics_by_group(inputs.predictions(spark, d), ["store_id", "product_id"])),
    **{f"metrics_by_{k}": _by(c) for k, c in (("store", "store_id"), ("product", "product_id"), ("category", "first_category_id"))},
    "evaluate_df": lambda spark, d: _rounded(metrics.evaluate(inputs.predictions(spark, d))),
    "business_metrics": lambda spark, d: _rounded(metrics.business_metrics(inputs.predictions(spark, d))),
    "compare_models": compare_models,
    "residuals": lambda spark, d: _rounded(
        metrics.residuals(inputs.predictions(spark, d)).select(*ROW, "residual", "abs_residual")),
    "train_r2": train_r2,
}
