from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelftide.operators import quantiles


def _df(spark, columns):
    n = max(len(v) for v in columns.values())
    rows = [tuple(None if i >= len(v) or v[i] is None else float(v[i]) for v in columns.values()) for i in range(n)]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns)).repartition(5)


CASES = {
    "single": [3.5],
    "two": [2.0, 3.0],
    "zeros": [0.0] * 90 + [1.0, 2.0, 300.0],
    "signs": [-5.0, -0.0, 0.0, 1e-40, -1e-40, 7.25, 1e12, -1e12, 3.0],
    "infinite": [float("-inf"), -1e300, 1.0, 2.0, 3.0, 1.7976931348623157e308, float("inf"), float("inf")],
    "all sizes": [s * 2.0**k for k in range(-1070, 1020, 13) for s in (-1, 1)],
    "ties": [1.0, 1.0, 1.0, 2.0, 2.0, 9.0],
}


@pytest.fixture(params=["few", "counted", "cut"], autouse=True)
def path(request, monkeypatch):
    """All values are counted; or ranges are cut, the small ones counted; or cut until one value is left."""
    if request.param != "few":
        monkeypatch.setattr(quantiles, "FEW_VALUES", -1)
    if request.param == "cut":
        monkeypatch.setattr(quantiles, "FEW_ROWS", 0)


@pytest.mark.parametrize("name", CASES)
def test_matches_numpy(spark, name):
    values = CASES[name]
    qs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = {r.q: r.value for r in quantiles.exact_percentiles(_df(spark, {"x": values}), ["x"], qs).collect()}
    for q in qs:
        ranked = sorted(values)
        at = (len(values) - 1) * q
        low, high = ranked[int(np.floor(at))], ranked[int(np.ceil(at))]
        want = low if low == high else (np.ceil(at) - at) * low + (at - np.floor(at)) * high
        assert got[q] == want or np.isnan(want) and np.isnan(got[q])


def test_several_columns_with_nulls(spark):
    rng = np.random.default_rng(1)
    cols = {"a": list(rng.normal(0, 100, 500)), "b": list(np.round(rng.gamma(1, 2, 400), 1)), "c": [None, None]}
    row = quantiles.percentile_row(_df(spark, cols), ["a", "b", "c"], [0.25, 0.5]).first()
    for c in ("a", "b"):
        assert row[f"{c}_q25"] == pytest.approx(np.quantile(cols[c], 0.25), rel=1e-12)
        assert row[f"{c}_q50"] == pytest.approx(np.quantile(cols[c], 0.5), rel=1e-12)
    assert row["c_q50"] is None


def test_buckets_follow_the_order_of_values(spark):
    values = sorted([-1e9, -3.0, -2.999999, -1e-20, 0.0, 1e-35, 1e-20, 1.0, 1.0001, 1.5, 2.0, 1e9])
    from pyspark.sql import functions as F

    out = _df(spark, {"x": values}).select("x", quantiles.magnitude_bucket(F.col("x")).alias("b")).orderBy("x").collect()
    buckets = [r.b for r in out]
    assert buckets == sorted(buckets)


def test_agrees_with_the_built_in_percentile(spark):
    df = spark.range(1000).select((F.rand(3) * 100).alias("v"))
    qs = [0.1, 0.25, 0.3, 0.5, 0.77]
    built_in = df.agg(F.percentile("v", F.array(*[F.lit(q) for q in qs]))).first()[0]
    assert [quantiles.percentiles(df, ["v"], qs)["v", q] for q in qs] == built_in


def test_one_outlier_costs_one_round(spark, monkeypatch):
    """Consecutive values and one far away: the second round has many buckets."""
    monkeypatch.setattr(quantiles, "FEW_ROWS", 100)
    monkeypatch.setattr(quantiles, "FEW_VALUES", -1)
    df = spark.range(100_000).select(F.col("id").cast("double").alias("v")).union(spark.createDataFrame([(-1e12,)], "v double"))
    rounds = []
    cut = quantiles._cut
    monkeypatch.setattr(quantiles, "_cut", lambda *a: rounds.append([r.n for r in a[1]]) or cut(*a))
    assert quantiles.percentiles(df, ["v"], [0.5, 0.25]) == {("v", 0.5): 49_999.0, ("v", 0.25): 24_999.0}
    assert rounds[0] == [100_001] and len(rounds) <= 3


def test_a_range_that_cannot_be_cut_is_counted(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "FEW_ROWS", 0)
    top = 1.7976931348623157e308
    df = _df(spark, {"x": [top] * 5 + [float("inf")] * 6})
    assert quantiles.percentiles(df, ["x"], [0.0, 0.4, 1.0]) == {("x", 0.0): top, ("x", 0.4): top, ("x", 1.0): float("inf")}


def test_no_rows(spark):
    df = spark.createDataFrame([], "x double, y long")
    assert quantiles.percentiles(df, ["x", "y"], [0.5]) == {("x", 0.5): None, ("y", 0.5): None}
    assert quantiles.median_of(df, "x").first()["median"] is None
