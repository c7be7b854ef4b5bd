"""Load, profile, build features, fit, score and store one model or several."""

from __future__ import annotations

import json
import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..forecast.base import Forecaster, Model
from ..forecast.linear import Linear
from ..forecast.naive import MovingAverage, Naive, SeasonalNaive, SeasonalProfile, SimpleNaive
from ..forecast.stack import Stacked
from ..forecast.tree import Tree
from ..operators import metrics
from ..operators.profile import data_summary
from ..sources import sinks
from ..sources.sales import sample_series
from .features import features_basic, features_model, model_feature_names

NAIVE = ("naive", "last", "mean", "drift", "seasonal_profile", "simple_naive", "seasonal_naive", "moving_average")


def create_model(name: str, settings: Settings | None = None, features: Sequence[str] | None = None, **options) -> Forecaster:
    """Forecaster by name."""
    s = settings or Settings()
    if name in ("naive", "last", "mean", "drift"):
        return Naive("seasonal" if name == "naive" else name, s.naive.seasonal_period)
    if name == "seasonal_profile":
        return SeasonalProfile(s.features.seasonal_periods)
    if name == "simple_naive":
        return SimpleNaive()
    if name == "seasonal_naive":
        return SeasonalNaive(s.naive.weekly_period)
    if name == "moving_average":
        return MovingAverage(s.naive.windows, s.naive.weights)
    if name in ("linear", "ridge", "lasso", "elasticnet"):
        return Linear(**{
            "features": features, "kind": name, "alpha": s.linear.alpha, "l1_ratio": s.linear.l1_ratio, "impute": s.linear.impute,
            "scaling": s.linear.scaling, "seed": s.train.seed, "holdout": s.train.test_size, **options,
        })
    if name in ("decision_tree", "random_forest", "gradient_boosting", "boosted_colsample"):
        return Tree(**{
            "features": features, "kind": name, **vars(s.tree), "seed": s.train.seed, "holdout": s.train.test_size, **options,
        })
    if name == "stacked":
        return Stacked(**{
            "features": features or model_feature_names(s.features.lags), "folds": s.train.folds, "seed": s.train.seed,
            "holdout": s.train.test_size, "fill": s.features.fill_value, **options,
        })
    raise ValueError(f"unknown model: {name}")


@dataclass
class Run:
    """Outcome of one experiment. ``record`` is one row."""

    model: Model
    predictions: DataFrame
    record: DataFrame
    summary: DataFrame


def run_experiment(
    train: DataFrame,
    evaluation: DataFrame,
    name: str = "linear",
    settings: Settings | None = None,
    output: str | None = None,
    **options,
) -> Run:
    """One model, scored on training and evaluation rows.

    The stacked model gets cycles and lags, the others the basic features.
    """
    spark = train.sparkSession
    settings = settings or Settings()
    if settings.train.sample_fraction < 1:
        train, evaluation = (sample_series(d, settings.train.sample_fraction, settings.train.seed) for d in (train, evaluation))
    if name == "stacked":
        lags, fill = settings.features.lags, settings.features.fill_value
        past, future = (features_model(d, lags, fill=fill) for d in (train, evaluation))
    else:
        past, future = features_basic(train), features_basic(evaluation)
    forecaster = create_model(name, settings, **options)
    start = time.time()
    model = forecaster.fit(past)
    seconds = time.time() - start
    scored = model.transform(future)
    fit_score = metrics.all_metrics(model.transform(past))
    score = metrics.all_metrics(scored, past)
    importance = model.importance() or {}
    ranked = dict(sorted(importance.items(), key=lambda kv: (-kv[1], kv[0])))
    about = model.summary()
    record = spark.range(1).select(
        F.lit(about["model_name"]).alias("model_name"),
        F.lit(seconds).alias("training_time_seconds"),
        F.lit(len(model.feature_names)).alias("n_features"),
        F.lit(json.dumps(about["config"], default=str)).alias("model_config"),
        F.lit(json.dumps(ranked)).alias("feature_importance"),
        fit_score.select(F.struct(*fit_score.columns)).scalar().alias("train_metrics"),
        score.select(F.struct(*score.columns)).scalar().alias("eval_metrics"),
        past.agg(F.count(F.lit(1))).scalar().alias("n_train_samples"),
        future.agg(F.count(F.lit(1))).scalar().alias("n_eval_samples"),
    )
    run = Run(model, scored, record, data_summary(train, evaluation))
    if output:
        save_results(spark, run, output)
    return run


def save_results(spark: SparkSession, run: Run, path: str) -> None:
    run.model.save(spark, f"{path}/model")
    sinks.write_results(run.record, f"{path}/results")
    sinks.write_predictions(run.predictions, f"{path}/predictions")


def evaluate_baselines(
    train: DataFrame, evaluation: DataFrame, models: dict[str, Forecaster], output: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Core metrics per model, and the business segments per model."""
    past, future = features_model(train), features_model(evaluation)
    volume = train.groupBy("product_id").agg(F.sum("sale_amount").alias("product_volume"))
    future = future.join(volume, "product_id", "left")
    scored, segments = None, None
    for name, forecaster in models.items():
        part = forecaster.fit(past).transform(future)
        named = part.withColumn("model", F.lit(name))
        business = metrics.business_metrics(part).withColumn("model", F.lit(name))
        slim = named.select("model", "sale_amount", "prediction")
        scored = slim if scored is None else scored.unionByName(slim)
        segments = business if segments is None else segments.unionByName(business)
    core = metrics.compare_models(scored)
    if output:
        sinks.write_comparison(core, output)
    return core, segments
