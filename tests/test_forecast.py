from __future__ import annotations

import datetime as dt
import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelftide.forecast import naive
from shelftide.forecast.base import load_model
from shelftide.forecast.linear import Linear, baseline
from shelftide.forecast.stack import Stacked
from shelftide.forecast.tree import Tree
from shelftide.operators import metrics
from shelftide.plans import experiment

Y = "sale_amount"
START = dt.datetime(2024, 1, 1)


def hours(spark, series):
    rows = [
        (s, p, START + dt.timedelta(hours=h), None if y is None else float(y))
        for (s, p), ys in series.items() for h, y in enumerate(ys)
    ]
    return spark.createDataFrame(rows, "store_id long, product_id long, dt timestamp, sale_amount double")


def ask(spark, *keys, hour=0):
    rows = [(s, p, START + dt.timedelta(hours=hour)) for s, p in keys]
    return spark.createDataFrame(rows, "store_id long, product_id long, dt timestamp")


def predict(model, df):
    return {(r.store_id, r.product_id): r.prediction for r in model.transform(df).collect()}


@pytest.fixture(scope="module")
def history(spark):
    return hours(spark, {(1, 1): [1, 2, 6], (1, 2): [5], (1, 3): [4, None], (1, 4): [None, 3, -9]})


def test_naive_strategies(spark, history):
    keys = [(1, 1), (1, 2), (1, 3), (1, 4), (9, 9)]
    df = ask(spark, *keys)
    assert predict(naive.Naive("last").fit(history), df) == dict(zip(keys, [6.0, 5.0, 0.0, 0.0, 0.0]))
    assert predict(naive.Naive("mean").fit(history), df) == dict(zip(keys, [3.0, 5.0, 4.0, 0.0, 0.0]))
    assert predict(naive.Naive("seasonal", 2).fit(history), df) == dict(zip(keys, [4.0, 5.0, 0.0, 0.0, 0.0]))
    assert predict(naive.Naive("drift").fit(history), df) == dict(zip(keys, [8.5, 5.0, 0.0, 0.0, 0.0]))
    with pytest.raises(ValueError):
        naive.Naive("other")


def test_simple_naive_skips_nulls_and_falls_back(spark, history):
    got = predict(naive.SimpleNaive().fit(history), ask(spark, (1, 1), (1, 3), (1, 4), (9, 9)))
    assert got == {(1, 1): 6.0, (1, 3): 4.0, (1, 4): -9.0, (9, 9): 3.0}
    assert predict(naive.SimpleNaive(fallback=7).fit(history), ask(spark, (9, 9))) == {(9, 9): 7.0}


def test_seasonal_naive_needs_the_exact_hour(spark, history):
    model = naive.SeasonalNaive(period=24).fit(history)
    assert predict(model, ask(spark, (1, 1), hour=25)) == {(1, 1): 2.0}
    assert predict(model, ask(spark, (1, 1), hour=30)) == {(1, 1): 3.0}


def test_seasonal_profile(spark):
    ys = list(range(48))
    for hot_rows in (10_000, 5):
        model = naive.SeasonalProfile((24, 168), hot_rows=hot_rows).fit(hours(spark, {(1, 1): ys}))
        assert predict(model, ask(spark, (1, 1), (2, 2), hour=3)) == {(1, 1): 15.0, (2, 2): 0.0}


@pytest.mark.parametrize("hot_rows", [10_000, 5])
def test_moving_average(spark, hot_rows):
    ys = [3.0, None, 4.0, 8.0, 1.0, 2.0, 9.0]
    df = hours(spark, {(1, 1): ys, (1, 2): [5.0], (1, 3): [2.0] * 40 + [None] * 30})
    model = naive.MovingAverage((3, 6), hot_rows=hot_rows).fit(df)

    def part(values):
        v = np.array([x for x in values if x is not None])
        w = np.exp(np.linspace(-1, 0, len(v)))
        return (v * w).sum() / w.sum()

    want = (part(ys[-3:]) / 3 + part(ys[-6:]) / 6) / (1 / 3 + 1 / 6)
    got = predict(model, ask(spark, (1, 1), (1, 2), (1, 3), (9, 9)))
    assert got[(1, 1)] == pytest.approx(want) and got[(1, 2)] == pytest.approx(5.0)
    # No value inside any window, and no series at all: the median of all values.
    assert got[(1, 3)] == got[(9, 9)] == 2.0
    with pytest.raises(ValueError):
        naive.MovingAverage((3, 6), weights=[1.0])


def test_unfitted_and_missing(spark, history, tmp_path):
    with pytest.raises(ValueError):
        naive.Naive("last").save(spark, str(tmp_path / "m"))
    with pytest.raises(ValueError):
        naive.Naive("last").transform(history)
    with pytest.raises(ValueError):
        naive.Naive("last").fit(history.drop("store_id"))
    with pytest.raises(FileNotFoundError):
        load_model(spark, str(tmp_path / "nothing"))
    assert naive.Naive("last").summary()["is_fitted"] is False


def rows_of(spark, pdf):
    return spark.createDataFrame([tuple(map(float, r)) for r in pdf.to_numpy()], ", ".join(f"{c} double" for c in pdf))


@pytest.fixture(scope="module")
def regression():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 3)) * [1, 5, 0.3] + [0, 10, 2]
    y = x @ [2.0, -0.5, 0.0] + 4 + rng.normal(0, 0.5, 300)
    return pd.DataFrame(x, columns=["a", "b", "c"]).assign(sale_amount=y)


def _scaled(pdf):
    x = pdf[["a", "b", "c"]].to_numpy()
    return (x - x.mean(0)) / x.std(0), pdf[Y].to_numpy()


def _fit(spark, pdf, **kw):
    model = Linear(features=["a", "b", "c"], **kw).fit(rows_of(spark, pdf))
    c = model.coefficients()
    return np.array([c["a"], c["b"], c["c"]]), c["intercept"], model


def test_least_squares(spark, regression):
    z, y = _scaled(regression)
    want = np.linalg.lstsq(np.c_[z, np.ones(len(z))], y, rcond=None)[0]
    got, intercept, model = _fit(spark, regression, kind="linear")
    np.testing.assert_allclose([*got, intercept], want, rtol=1e-8)
    residual = y - np.c_[z, np.ones(len(z))] @ want
    assert model.history["train_r2"] == pytest.approx(1 - residual @ residual / ((y - y.mean()) ** 2).sum())


def test_ridge(spark, regression):
    z, y = _scaled(regression)
    for alpha in (1.0, 250.0):
        want = np.linalg.solve(z.T @ z + alpha * np.eye(3), z.T @ (y - y.mean()))
        got, intercept, _ = _fit(spark, regression, kind="ridge", alpha=alpha)
        np.testing.assert_allclose(got, want, rtol=1e-7)
        assert intercept == pytest.approx(y.mean())


@pytest.mark.parametrize("kind, ratio", [("lasso", 1.0), ("elasticnet", 0.5)])
def test_penalised(spark, regression, kind, ratio):
    z, y = _scaled(regression)
    n, w, alpha = len(y), np.zeros(3), 0.4
    for _ in range(3000):
        for j in range(3):
            r = y - y.mean() - z @ w + z[:, j] * w[j]
            rho = z[:, j] @ r / n
            w[j] = np.sign(rho) * max(abs(rho) - alpha * ratio, 0) / (1 + alpha * (1 - ratio))
    got, _, _ = _fit(spark, regression, kind=kind, alpha=alpha, l1_ratio=ratio)
    np.testing.assert_allclose(got, w, rtol=1e-5, atol=1e-6)


def test_nulls_are_filled_with_the_training_median(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (4.0, 4.0), (None, 2.0)], "a double, sale_amount double")
    model = Linear(features=["a"], kind="linear").fit(df)
    assert model.inputs.fill == {"a": 2.0}
    out = model.transform(spark.createDataFrame([(None,), (float("nan"),), (-9.0,)], "a double")).collect()
    assert out[0].prediction == pytest.approx(2.0) and out[1].prediction == pytest.approx(2.0) and out[2].prediction == 0.0


def test_text_columns_are_left_out(spark, regression):
    df = rows_of(spark, regression).withColumn("note", F.lit("x"))
    assert Linear(kind="linear").fit(df).feature_names == ["a", "b", "c"]
    with pytest.raises(ValueError):
        Linear(kind="other")


@pytest.mark.parametrize("kind", ["decision_tree", "random_forest", "gradient_boosting", "boosted_colsample"])
def test_trees(spark, kind, regression, tmp_path):
    df = rows_of(spark, regression.assign(sale_amount=lambda d: np.where(d.a > 0, 20.0, 2.0) + d.c))
    tree = Tree(features=["a", "b", "c"], kind=kind, num_trees=5, max_depth=4)
    model = tree.fit(df)
    out = [r.prediction for r in model.transform(df).orderBy("a", "b").collect()]
    assert out == [r.prediction for r in tree.fit(df).transform(df).orderBy("a", "b").collect()]
    assert min(out) >= 0
    error = metrics.evaluate(model.transform(df)).first().mae
    flat = df.select(F.avg(F.abs(F.col(Y) - df.agg(F.avg(Y)).scalar()))).first()[0]
    assert error < flat
    importance = model.importance()
    assert max(importance, key=importance.get) == "a" and sum(importance.values()) == pytest.approx(1)
    detail = model.importance_detail(spark).collect()
    assert [r["rank"] for r in detail] == [1, 2, 3] and detail[0].top_5_share == pytest.approx(1)
    path = str(tmp_path / kind)
    model.save(spark, path)
    back = load_model(spark, path)
    assert out == [r.prediction for r in back.transform(df).orderBy("a", "b").collect()]


def test_stacked(spark, regression, tmp_path):
    pdf = regression.assign(sale_amount=lambda d: d[Y].abs(), store_id=1, product_id=np.arange(len(regression)) % 7,
                            h=np.arange(len(regression)))
    df = rows_of(spark, pdf).select(
        "a", "b", "c", Y, F.col("store_id").cast("long"), F.col("product_id").cast("long"),
        F.timestamp_add("HOUR", F.col("h").cast("int"), F.lit(START)).alias("dt"))
    bases = {"linear": baseline(["a", "b", "c"]), "tree": Tree(kind="decision_tree", max_depth=3)}
    model = Stacked(["a", "b", "c"], bases, folds=3).fit(df)
    assert model.meta.feature_names == ["base_linear", "base_tree", "a", "b", "c"]
    out = model.transform(df)
    assert out.columns == [*df.columns, "prediction"] and out.filter("prediction < 0").count() == 0
    assert {"validation_mae", "validation_rmse"} <= set(model.history)
    path = str(tmp_path / "s")
    model.save(spark, path)
    a = [r.prediction for r in out.orderBy("dt").collect()]
    b = [r.prediction for r in load_model(spark, path).transform(df).orderBy("dt").collect()]
    np.testing.assert_allclose(a, b)


def test_linear_round_trip(spark, regression, tmp_path):
    df = rows_of(spark, regression)
    model = Linear(features=["a", "b", "c"], kind="ridge").fit(df)
    model.save(spark, str(tmp_path / "m"))
    back = load_model(spark, str(tmp_path / "m"))
    assert back.coefficients() == model.coefficients() and back.summary()["num_features"] == 3


def test_model_factory():
    for name in (*experiment.NAIVE, "linear", "ridge", "lasso", "elasticnet", "decision_tree", "random_forest",
                 "gradient_boosting", "boosted_colsample", "stacked"):
        assert experiment.create_model(name)
    with pytest.raises(ValueError):
        experiment.create_model("other")


def test_experiment_writes_everything(spark, sf_dir, tmp_path):
    from checks import inputs

    past, future = inputs.train(spark, sf_dir), inputs.evaluation(spark, sf_dir)
    run = experiment.run_experiment(past, future, "decision_tree", output=str(tmp_path / "run"), max_depth=3)
    r = run.record.first()
    assert (r.n_train_samples, r.n_eval_samples) == (6624, 2016) and r.eval_metrics.mase > 0
    assert spark.read.parquet(str(tmp_path / "run/predictions")).count() == 2016
    assert spark.read.json(str(tmp_path / "run/results")).first().model_name == "tree_decision_tree"
    assert load_model(spark, str(tmp_path / "run/model")).summary()["is_fitted"]


def test_settings_reach_the_models():
    from shelftide.config import FeatureSettings, LinearSettings, Settings, TrainSettings, TreeSettings

    s = Settings(
        features=FeatureSettings(lags=(2,), fill_value=1.5), linear=LinearSettings(alpha=3.0, l1_ratio=0.1),
        tree=TreeSettings(num_trees=7, max_depth=3, min_leaf=9, learning_rate=0.3, subsample=0.5, feature_subset="log2"),
        train=TrainSettings(test_size=0.1, folds=3, seed=5),
    )
    forest = experiment.create_model("random_forest", s)
    assert (forest.num_trees, forest.max_depth, forest.min_leaf, forest.feature_subset) == (7, 3, 9, "log2")
    assert (forest.learning_rate, forest.subsample, forest.seed, forest.holdout) == (0.3, 0.5, 5, 0.1)
    net = experiment.create_model("elasticnet", s)
    assert (net.alpha, net.l1_ratio, net.holdout) == (3.0, 0.1, 0.1)
    stack = experiment.create_model("stacked", s)
    assert (stack.folds, stack.seed, stack.holdout, stack.fill) == (3, 5, 0.1, 1.5) and "sale_amount_lag_2" in stack.features
    assert experiment.create_model("random_forest").num_trees == 100


def test_stacked_experiment_on_a_sample(spark, sf_dir):
    from checks import inputs
    from shelftide.config import Settings, TrainSettings, TreeSettings
    from shelftide.forecast.linear import Linear

    past, future = inputs.train(spark, sf_dir), inputs.evaluation(spark, sf_dir)
    s = Settings(tree=TreeSettings(num_trees=2, max_depth=2), train=TrainSettings(folds=2, sample_fraction=0.5))
    bases = {"linear": Linear(kind="ridge", impute="constant"), "tree": experiment.create_model("gradient_boosting", s)}
    row = experiment.run_experiment(past, future, "stacked", s, bases=bases).record.first()
    assert 0 < row["n_train_samples"] < past.count()
    assert len(json.loads(row["feature_importance"])) == 9


def test_fitted_table_is_held(spark, sf_dir):
    from checks import inputs

    model = naive.MovingAverage().fit(inputs.train(spark, sf_dir))
    assert model.table.is_cached
    model.release()
    assert not model.table.is_cached
