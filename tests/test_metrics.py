from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelftide.operators import metrics

COLUMNS = "store_id long, hour int, hours_stock_status int, product_volume double, sale_amount double, prediction double"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), COLUMNS)


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(5)
    y = np.round(rng.gamma(1, 5, 200), 4)
    y[:60] = 0
    p = np.abs(y + rng.normal(0, 2, 200))
    rows = [(int(i % 3), int(i % 24), int(i % 2), float(i % 7), float(a), float(b)) for i, (a, b) in enumerate(zip(y, p))]
    return y, p, frame(spark, *rows)


def test_all_metrics_match_numpy(scored):
    y, p, df = scored
    e = np.abs(y - p)
    r = metrics.all_metrics(df).first()
    assert r.mae == pytest.approx(e.mean())
    assert r.rmse == pytest.approx(np.sqrt((e**2).mean()))
    assert r.mape == pytest.approx((e / np.maximum(np.abs(y), 1e-8)).mean() * 100)
    assert r.smape == pytest.approx((e / ((np.abs(y) + np.abs(p)) / 2 + 1e-8)).mean() * 100)
    assert r.bias == pytest.approx((p - y).mean())
    assert r.bias_pct == pytest.approx((p - y).mean() / (y.mean() + 1e-8) * 100)
    core = metrics.evaluate(df).first()
    assert core.mape == pytest.approx((e[y != 0] / y[y != 0]).mean() * 100)
    assert metrics.r2(df).first().r2 == pytest.approx(1 - (e**2).sum() / ((y - y.mean()) ** 2).sum())


def test_zero_sales_have_no_percentage(spark):
    df = frame(spark, (1, 1, 1, 1.0, 0.0, 2.0), (1, 1, 1, 1.0, 0.0, 0.0))
    r = metrics.evaluate(df).first()
    assert r.mape is None and r.mae == 1.0


def test_groups_drop_null_keys(spark):
    df = frame(spark, (1, 1, 1, 1.0, 2.0, 2.0), (None, 1, 1, 1.0, 2.0, 3.0))
    rows = metrics.metrics_by_group(df, ["store_id"]).collect()
    assert [(r.store_id, r.n_observations, r.mae) for r in rows] == [(1, 1, 0.0)]


def test_segments(spark):
    df = frame(
        spark, (1, 17, 0, 1.0, 2.0, 3.0), (1, 20, 1, 5.0, 2.0, 2.0), (1, None, None, None, 2.0, 6.0), (1, 3, 1, 3.0, 2.0, 4.0))
    r = {x.segment: x for x in metrics.business_metrics(df).collect()}
    assert list(metrics.SEGMENTS) == list(r)
    assert (r["HighVolume"].n_observations, r["LowVolume"].n_observations) == (1, 2)
    # An unknown hour is off peak, an unknown volume or stock status in neither half.
    assert (r["PeakHours"].n_observations, r["OffPeakHours"].n_observations) == (2, 2)
    assert (r["Stockout"].n_observations, r["InStock"].n_observations) == (1, 2)
    assert r["OffPeakHours"].mae == 3.0


def test_empty_segment_stays(spark):
    r = {x.segment: x for x in metrics.business_metrics(frame(spark, (1, 3, 1, 1.0, 2.0, 4.0))).collect()}
    assert len(r) == 6 and r["Stockout"].mae is None and r["Stockout"].n_observations == 0


@pytest.mark.parametrize("cut", [{}, {"hot_rows": 3, "block_rows": 4}])
def test_mase(spark, cut):
    ys = [1.0, 4.0, 2.0, 8.0, 5.0, 7.0, 7.0, 1.0]
    train = spark.createDataFrame(
        [(1, 1, h, y) for h, y in enumerate(ys)], "store_id long, product_id long, h int, sale_amount double"
    ).withColumn("dt", F.timestamp_add("HOUR", F.col("h"), F.lit("2024-01-01").cast("timestamp")))
    df = frame(spark, (1, 1, 1, 1.0, 3.0, 5.0), (1, 1, 1, 1.0, 4.0, 4.0))
    for period in (1, 3):
        steps = np.abs(np.array(ys[period:]) - np.array(ys[:-period])).mean()
        assert metrics.mase(df, train, period, **cut).first().mase == pytest.approx(1.0 / (steps + 1e-8))
    short = np.abs(np.array([3.0, 4.0]) - np.mean(ys)).mean()
    assert metrics.mase(df, train, 8, **cut).first().mase == pytest.approx(1.0 / (short + 1e-8))
