"""Trees grown from histograms: against brute force, one task against many, and the number of Spark jobs."""

from __future__ import annotations

import tempfile
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from shelftide.forecast import grow
from shelftide.forecast.inputs import VECTOR, Inputs
from shelftide.forecast.tree import Tree

FIELDS = "a double, b double, c double, sale_amount double"


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(5)
    x = np.stack([rng.integers(0, 24, 3000), rng.integers(0, 7, 3000), np.where(rng.random(3000) < 0.8, 0, rng.gamma(1, 30, 3000))])
    y = np.round(np.where(x[0] > 11, 20, 3) + x[1] * (x[2] > 5) + rng.random(3000), 3)
    return x, y


@pytest.fixture(scope="module")
def rows(spark, table):
    x, y = table
    return spark.createDataFrame([tuple(map(float, r)) for r in zip(*x, y)], FIELDS).repartition(3).cache()


def brute_force(x, y, rows, depth, min_leaf):
    """Prediction of each row by the best cut among all middles, again and again."""
    out, best = np.full(len(y), y[rows].mean()), (1e-9, None)
    for column in x if depth else ():
        values = np.unique(column[rows])
        for cut in (values[:-1] + values[1:]) / 2:
            go = column[rows] <= cut
            a, b = y[rows][go], y[rows][~go]
            if min(len(a), len(b)) >= min_leaf:
                gain = len(a) * len(b) / len(rows) * (a.mean() - b.mean()) ** 2
                if gain > best[0] * (1 + 1e-9):
                    best = gain, (rows[go], rows[~go])
    if best[1]:
        for part in best[1]:
            out[part] = brute_force(x, y, part, depth - 1, min_leaf)[part]
    return out


def test_one_tree_equals_brute_force(spark, table, rows):
    x, y = table
    x, y = x[:, :400], y[:400]
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*x, y)], FIELDS)
    model = Tree(["a", "b", "c"], kind="gradient_boosting", num_trees=1, max_depth=4, min_leaf=5, subsample=1.0, max_bins=400).fit(df)
    got = model.raw(df, "p").orderBy("a", "b", "c", "sale_amount").collect()
    want = brute_force(x, y, np.arange(400), 4, 5)[np.lexsort((y, *x[::-1]))]
    np.testing.assert_allclose([r.p for r in got], want, rtol=1e-9)


@pytest.mark.parametrize("subset", ["all", "0.6"])
def test_one_task_and_a_job_per_level_agree(spark, rows, subset, monkeypatch):
    def trees(alone):
        monkeypatch.setattr(grow, "TASK_ROWS", 500)
        monkeypatch.setattr(grow, "LINEAGE", 3)
        boost = grow.boost
        monkeypatch.setattr(grow, "boost", lambda *a: boost(*a[:-1], alone))
        model = Tree(["a", "b", "c"], kind="gradient_boosting", num_trees=8, max_depth=4, feature_subset=subset).fit(rows)
        monkeypatch.setattr(grow, "boost", boost)
        return [r.p for r in model.raw(rows, "p").orderBy("a", "b", "c", "sale_amount").collect()], model.fitted.totalNumNodes

    one, many = trees(10**9), trees(0)
    np.testing.assert_allclose(one[0], many[0], rtol=1e-6)
    assert one[1] == many[1]


@pytest.mark.parametrize("kind", ["random_forest", "boosted_colsample"])
def test_prediction_is_that_of_the_stored_spark_model(rows, kind):
    model = Tree(["a", "b", "c"], kind=kind, num_trees=7, max_depth=6).fit(rows)
    own = model.raw(rows, "own")
    spark_own = model.fitted.transform(model.inputs.assemble(own))
    assert model.fitted.grown is not None and model.trees() == 7
    assert spark_own.filter(F.abs(F.col("own") - F.col("_prediction")) > 1e-9).count() == 0


def test_blocks_in_files_and_cells_in_pieces_change_nothing(table, monkeypatch):
    x, y = table
    cuts = [grow.thresholds(*np.unique(c, return_counts=True), 64) for c in x]
    bins = grow._block(cuts, x, y)[0]
    parts = [([(0, 0), (0, 1)], [1000, 500], bins[:, :1500], y[:1500]), ([(1, 0)], [1500], bins[:, 1500:], y[1500:])]
    shape = dict(columns=3, bins=64, subset=2, depth=9, min_leaf=3)
    with tempfile.TemporaryDirectory() as folder:
        whole = grow.grow_tree(parts, shape, (1, 2), grow.Held(folder, 1 << 30))
        monkeypatch.setattr(grow, "CELLS", 300)
        pieces = grow.grow_tree(parts, shape, (1, 2), grow.Held(folder, 1000))
    for name in ("feature", "cut", "left", "count", "total"):
        np.testing.assert_array_equal(getattr(whole, name), getattr(pieces, name))


def test_a_frequent_value_takes_one_bin():
    values, counts = np.arange(1000.0), np.ones(1000, np.int64)
    counts[0] = 9000
    cuts = grow.thresholds(values, counts, 64)
    assert len(cuts) == 63 and cuts[0] == 0.5
    assert np.diff(cuts).max() <= 17 and cuts[-1] >= 980


@pytest.mark.parametrize("kind, most", [("random_forest", 25), ("gradient_boosting", 25), ("boosted_colsample", 25)])
def test_few_spark_jobs(spark, rows, kind, most):
    """Spark ML starts one job or more for each level of each round."""
    sc = spark.sparkContext
    sc.setJobGroup(f"fit-{kind}", kind)
    try:
        Tree(["a", "b", "c"], kind=kind, num_trees=20, impute="constant").fit(rows)
        assert len(sc.statusTracker().getJobIdsForGroup(f"fit-{kind}")) <= most
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_stacked_fits_share_the_cores(spark, rows, monkeypatch):
    """Fits side by side take one task each; a fit that stands alone is dealt out sooner."""
    from shelftide.forecast.stack import Stacked

    limits, boost = [], grow.boost
    monkeypatch.setattr(grow, "boost", lambda *a: limits.append(a[-1]) or boost(*a))
    df = rows.withColumns({"store_id": F.lit(1), "product_id": F.col("a").cast("int"), "dt": F.timestamp_seconds(F.monotonically_increasing_id())})
    base = Tree(kind="boosted_colsample", num_trees=2, max_depth=2, impute="constant")
    Stacked(["a", "b", "c"], {"boosted": base}, folds=2, parallelism=3).fit(df)
    replace(base, features=["a", "b", "c"]).fit(df)
    assert limits == [3 * grow.ALONE] * 3 + [grow.ALONE]


def test_columns_per_node_follow_spark():
    assert [grow.columns_per_node(r, 7, 100) for r in ("all", "sqrt", "log2", "onethird", "auto", "0.8", "4", "1.0")] == [7, 3, 3, 3, 3, 6, 4, 7]


def test_bad_values_are_refused(spark):
    for bad in ((float("inf"), 1.0), (1.0, float("nan"))):
        df = spark.createDataFrame([bad, (2.0, 3.0)], "a double, sale_amount double")
        with pytest.raises(Exception, match="finite|NaN"):
            Tree(["a"], kind="random_forest", num_trees=2, impute="constant").fit(df)
    empty = spark.createDataFrame([], "a double, sale_amount double")
    for kind in (GBTRegressor(featuresCol=VECTOR), RandomForestRegressor(featuresCol=VECTOR)):
        with pytest.raises(ValueError):
            grow.Grower(kind).fit(Inputs(["a"]).assemble(empty).withColumnRenamed("sale_amount", "label"))
