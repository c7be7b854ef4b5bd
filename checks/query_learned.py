"""Registered queries: linear, tree and stacked forecasters, pipelines, experiments, model storage."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelftide.forecast import naive
from shelftide.forecast.base import importance_rows, load_model
from shelftide.forecast.linear import Linear
from shelftide.forecast.stack import Stacked
from shelftide.forecast.tree import Tree
from shelftide.forecast.vector import cross_validation_summary
from shelftide.operators import prep
from shelftide.plans import experiment, features
from shelftide.sources import sinks

from . import inputs
from .query_profile import ROW, _rounded

Y = "sale_amount"
WEEK = f"{Y}_lag_168"


def _train(spark, sf_dir):
    return features.features_model(inputs.train(spark, sf_dir))


def _eval(spark, sf_dir):
    return features.features_model(inputs.evaluation(spark, sf_dir))


def _coefficients(names=None, **options):
    """Fit on the same hour of last week, or the features of ``names()``, and report the coefficients."""

    def run(spark, sf_dir):
        model = Linear(features=names() if names else [WEEK], impute="constant", **options).fit(_train(spark, sf_dir))
        return _rounded(model.coefficient_rows(spark))

    return run


def two_coefficients(spark, sf_dir):
    model = Linear(features=[f"{Y}_lag_1", WEEK], impute="constant", scaling=None).fit(_train(spark, sf_dir))
    return _rounded(model.coefficient_rows(spark))


def cross_validate(spark, sf_dir):
    return _rounded(Linear(features=[WEEK], impute="constant", scaling=None).cross_validate(_train(spark, sf_dir), 5))


def cross_validate_summary(spark, sf_dir):
    scores = Linear(features=[WEEK], impute="constant", scaling=None).cross_validate(_train(spark, sf_dir), 5)
    return _rounded(cross_validation_summary(scores))


def cross_validate_full(spark, sf_dir):
    return _rounded(Linear(features=features.model_feature_names(), impute="constant").cross_validate(_train(spark, sf_dir), 5))


def _tree(kind, **options):
    def run(spark, sf_dir):
        model = Tree(features=features.model_feature_names(), kind=kind, impute="constant", **options).fit(_train(spark, sf_dir))
        return model.transform(_eval(spark, sf_dir)).select(*ROW, "prediction")

    return run


def _stump(spark, sf_dir, kind, **options):
    """One split by hour: exact, as each hour is a bin of its own."""
    past = inputs.train(spark, sf_dir).withColumn("hour", F.hour("dt"))
    return Tree(features=["hour"], kind=kind, max_depth=1, min_leaf=1, feature_subset="all", impute="constant", **options).fit(past)


def _stump_forecast(kind, **options):
    def run(spark, sf_dir):
        future = inputs.evaluation(spark, sf_dir).withColumn("hour", F.hour("dt"))
        return _rounded(_stump(spark, sf_dir, kind, **options).transform(future).select(*ROW, "prediction"))

    return run


def stump_importance(spark, sf_dir):
    return _rounded(importance_rows(spark, _stump(spark, sf_dir, "random_forest", num_trees=1).importance()))


def _forest(spark, sf_dir):
    return Tree(features=features.model_feature_names(), kind="random_forest", impute="constant").fit(_train(spark, sf_dir))


def stacked(spark, sf_dir):
    """The settings of the class: all rounds, all folds."""
    model = Stacked(features=features.model_feature_names(), parallelism=6).fit(_train(spark, sf_dir))
    return model.transform(_eval(spark, sf_dir)).select(*ROW, "prediction")


def stacked_small(spark, sf_dir):
    names = features.model_feature_names()
    bases = {
        "linear": Linear(kind="ridge", impute="constant"),
        "boosted": Tree(kind="boosted_colsample", num_trees=5, max_depth=4, impute="constant"),
    }
    model = Stacked(features=names, bases=bases, folds=3).fit(_train(spark, sf_dir))
    return model.transform(_eval(spark, sf_dir)).select(*ROW, "prediction")


def model_summary(spark, sf_dir):
    about = Linear(features=[f"{Y}_lag_1", WEEK], impute="constant", scaling=None).fit(_train(spark, sf_dir)).summary()
    row = (about["model_name"], about["is_fitted"], about["num_features"], about["training_history"]["train_r2"])
    return _rounded(spark.createDataFrame([row], "model_name string, is_fitted boolean, num_features int, train_r2 double"))


def _stored_model(rows):
    def run(spark, sf_dir):
        path = inputs.folder(spark, "model")
        naive.Naive("last").fit(rows(spark, sf_dir)).save(spark, path)
        return _rounded(load_model(spark, path).transform(inputs.evaluation(spark, sf_dir).select(*ROW)))

    return run


def write_comparison(spark, sf_dir):
    models = {"simple_naive": naive.SimpleNaive(), "seasonal_naive": naive.SeasonalNaive()}
    path = inputs.folder(spark, "comparison")
    experiment.evaluate_baselines(inputs.train(spark, sf_dir), inputs.evaluation(spark, sf_dir), models, path)
    back = spark.read.schema("model string, mae double, rmse double, mape double, bias double").option("header", True).csv(path)
    return _rounded(back)


def write_results(spark, sf_dir):
    run = experiment.run_experiment(inputs.train(spark, sf_dir), inputs.evaluation(spark, sf_dir), "naive")
    path = inputs.folder(spark, "results")
    sinks.write_results(run.record, path)
    return spark.read.json(path)


def run_experiment(spark, sf_dir):
    return experiment.run_experiment(inputs.train(spark, sf_dir), inputs.evaluation(spark, sf_dir), "ridge").record


def numeric_columns(spark, sf_dir):
    df = inputs.hb(spark, sf_dir)
    return df.select(*prep.numeric_columns(df, exclude=["store_id", "product_id", "city_id", "dt", Y]))


def features_basic(spark, sf_dir):
    df = inputs.sales(spark, sf_dir)
    out = features.features_basic(df)
    return _rounded(out.select(*ROW, *[c for c in out.columns if c not in df.columns]), 9)


def features_full(spark, sf_dir):
    df = inputs.sales(spark, sf_dir)
    out = features.features_full(df)
    return _rounded(out.select(*ROW, *[c for c in out.columns if c not in df.columns]), 9)


def lag_rolling(spark, sf_dir):
    df = inputs.sales(spark, sf_dir).select(*ROW, Y)
    return _rounded(features.lag_rolling(df), 6, 1e-9)


def features_model(spark, sf_dir):
    out = features.features_model(inputs.sales(spark, sf_dir).select(*ROW, Y))
    return _rounded(out, 9)


def features_model_history(spark, sf_dir):
    past, future = (d.select(*ROW, Y) for d in (inputs.train(spark, sf_dir), inputs.evaluation(spark, sf_dir)))
    return features.features_model(future, history=past).select(*ROW, *[f"{Y}_lag_{k}" for k in (1, 7, 168)])


QUERIES = {
    "linear_ols": _coefficients(kind="linear"),
    "linear_ridge": _coefficients(kind="ridge", alpha=1.0),
    "linear_lasso": _coefficients(kind="lasso", alpha=1.0),
    "linear_elasticnet": _coefficients(kind="elasticnet", alpha=1.0),
    "linear_ols_full": _coefficients(features.model_feature_names, kind="linear"),
    "linear_ridge_full": _coefficients(features.model_feature_names, kind="ridge", alpha=1.0),
    "linear_lasso_full": _coefficients(features.model_feature_names, kind="lasso", alpha=1.0),
    "linear_elasticnet_full": _coefficients(features.model_feature_names, kind="elasticnet", alpha=1.0),
    "cross_validate_full": cross_validate_full,
    "coefficients": two_coefficients,
    "cross_validate": cross_validate,
    "cross_validate_summary": cross_validate_summary,
    "tree_decision": _tree("decision_tree"),
    "tree_random_forest": _tree("random_forest"),
    "tree_gradient_boosting": _tree("gradient_boosting"),
    "tree_boosted_colsample": _tree("boosted_colsample"),
    "stump_decision": _stump_forecast("decision_tree"),
    "stump_gradient_boosting": _stump_forecast("gradient_boosting", num_trees=1, subsample=1.0),
    "stump_boosted_colsample": _stump_forecast("boosted_colsample", num_trees=1, subsample=1.0),
    "stump_importance": stump_importance,
    "importance_detail": lambda spark, d: _forest(spark, d).importance_detail(spark),
    "feature_importance": lambda spark, d: importance_rows(spark, _forest(spark, d).importance(), 10),
    "stacked": stacked,
    "stacked_small": stacked_small,
    "model_summary": model_summary,
    "save_model": _stored_model(inputs.seen_train),
    "save_model_all": _stored_model(inputs.train),
    "write_comparison": write_comparison,
    "write_results": write_results,
    "run_experiment": run_experiment,
    "numeric_columns": numeric_columns,
    "features_basic": features_basic,
    "features_full": features_full,
    "features_lag_rolling": lag_rolling,
    "features_model": features_model,
    "features_model_history": features_model_history,
}
