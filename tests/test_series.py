"""Window features against pandas, on whole series and on series cut into blocks."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelftide.operators import ranks, series, windows
from shelftide.plans import features

Y = "sale_amount"
KEYS = ["store_id", "product_id"]
ROW = [*KEYS, "dt"]

# Ordinary windows, and blocks of a few rows for every longer series.
CUTS = [{}, {"hot_rows": 60, "block_rows": 50}, {"hot_rows": 0, "block_rows": 37}]


def _frame(df):
    return df.toPandas().sort_values(ROW).reset_index(drop=True)


def _expected(pdf):
    return pdf.sort_values(ROW).reset_index(drop=True)


def _same(got, want):
    np.testing.assert_allclose(np.asarray(got, "float64"), np.asarray(want, "float64"), rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("cut", CUTS)
def test_lags(random_series, cut):
    pdf, df = random_series
    got, want = _frame(windows.lag_features(df, (1, 3, 24), **cut)), _expected(pdf)
    assert len(got) == len(want)
    for k in (1, 3, 24):
        _same(got[f"{Y}_lag_{k}"], want.groupby(KEYS)[Y].shift(k))


@pytest.mark.parametrize("cut", CUTS)
@pytest.mark.parametrize("slide", [4, 32])
def test_rolling_prior(random_series, cut, slide):
    pdf, df = random_series
    stats = ("mean", "std", "min", "max", "q25", "q75")
    fn = windows.rolling_columns(Y, (3, 6, 24), stats, "r_{stat}_{w}", prior=True, slide_up_to=slide)
    got = _frame(series.over_series(df, fn, KEYS, lookback=25, **cut))
    want = _expected(pdf)
    for w in (3, 6, 24):
        roll = want.groupby(KEYS)[Y].transform
        _same(got[f"r_mean_{w}"], roll(lambda x: x.shift(1).rolling(w).mean()))
        # Where all values of a window are equal pandas leaves a rounding residue.
        np.testing.assert_allclose(
            got[f"r_std_{w}"].astype(float), roll(lambda x: x.shift(1).rolling(w).std()), rtol=1e-7, atol=1e-5)
        _same(got[f"r_min_{w}"], roll(lambda x: x.shift(1).rolling(w).min()))
        _same(got[f"r_max_{w}"], roll(lambda x: x.shift(1).rolling(w).max()))
        _same(got[f"r_q25_{w}"], roll(lambda x: x.shift(1).rolling(w).quantile(0.25)))
        _same(got[f"r_q75_{w}"], roll(lambda x: x.shift(1).rolling(w).quantile(0.75)))


@pytest.mark.parametrize("cut", CUTS)
@pytest.mark.parametrize("slide", [4, 32])
def test_rolling_incl(random_series, cut, slide):
    pdf, df = random_series
    fn = windows.rolling_columns(Y, (6, 24), ("mean", "std", "max", "median"), "r_{stat}_{w}", prior=False, slide_up_to=slide)
    got = _frame(series.over_series(df, fn, KEYS, lookback=24, **cut))
    want = _expected(pdf)
    for w in (6, 24):
        roll = want.groupby(KEYS)[Y].transform
        _same(got[f"r_mean_{w}"], roll(lambda x: x.rolling(w, min_periods=1).mean()))
        np.testing.assert_allclose(
            got[f"r_std_{w}"].astype(float), roll(lambda x: x.rolling(w, min_periods=1).std().fillna(0)), rtol=1e-7, atol=1e-5)
        _same(got[f"r_max_{w}"], roll(lambda x: x.rolling(w, min_periods=1).max()))
        _same(got[f"r_median_{w}"], roll(lambda x: x.rolling(w, min_periods=1).median()))


@pytest.mark.parametrize("cut", CUTS)
def test_ewm(random_series, cut):
    pdf, df = random_series
    got, want = _frame(windows.ewm_prior(df, (3, 24), **cut)), _expected(pdf)
    assert len(got) == len(want)
    for s in (3, 24):
        _same(got[f"{Y}_ewm_{s}"], want.groupby(KEYS)[Y].transform(lambda x: x.shift(1).ewm(span=s, adjust=False).mean()))


def test_ewm_known_values(spark):
    rows = [(1, 1, h, y) for h, y in enumerate([1.0, None, 3.0, 5.0])]
    df = spark.createDataFrame(rows, "store_id long, product_id long, h int, sale_amount double")
    df = df.withColumn("dt", F.timestamp_add("HOUR", F.col("h"), F.lit("2024-01-01").cast("timestamp")))
    got = _frame(windows.ewm_prior(df, (3,)))[f"{Y}_ewm_3"].tolist()
    assert np.isnan(got[0]) and got[1:3] == [1.0, 1.0] and round(got[3], 4) == 2.3333


@pytest.mark.parametrize("cut", CUTS)
def test_holiday_neighbours_and_changes(random_series, cut):
    pdf, df = random_series
    got, want = _frame(windows.holiday_adjacent(df, **cut)), _expected(pdf)
    flags = want.groupby(KEYS)["holiday_flag"]
    _same(got["day_before_holiday"], flags.shift(-1).fillna(0))
    _same(got["day_after_holiday"], flags.shift(1).fillna(0))
    fn = windows.change_columns({Y: "change"})
    got = _frame(series.over_series(df, fn, KEYS, lookback=1, **cut))
    _same(got["change"], want.groupby(KEYS)[Y].diff().fillna(0))


@pytest.mark.parametrize("cut", CUTS)
def test_velocity(random_series, cut):
    pdf, df = random_series
    got = windows.product_velocity(df, **cut).toPandas().sort_values(["product_id", "dt", "store_id"])
    want = pdf.sort_values(["product_id", "dt", "store_id"])
    want = want.groupby("product_id")[Y].transform(lambda x: x.rolling(7).sum().fillna(0))
    _same(got["product_velocity"], want)


@pytest.mark.parametrize("hot_rows", [10_000, 60, 0])
def test_position(random_series, hot_rows):
    pdf, df = random_series
    got, want = _frame(series.with_position(df, KEYS, hot_rows=hot_rows)), _expected(pdf)
    _same(got["position"], want.groupby(KEYS).cumcount())


def test_short_block_still_holds_the_lookback(random_series):
    pdf, df = random_series
    got = _frame(windows.lag_features(df, (40,), hot_rows=0, block_rows=5))
    _same(got[f"{Y}_lag_40"], _expected(pdf).groupby(KEYS)[Y].shift(40))


@pytest.mark.parametrize("broadcast, hot_rows", [(10**6, 10**6), (0, 10**6), (0, 3)])
def test_dense_rank(random_series, monkeypatch, broadcast, hot_rows):
    monkeypatch.setattr(series, "BROADCAST_KEYS", broadcast)
    monkeypatch.setattr(series, "HOT_ROWS", hot_rows)
    pdf, df = random_series
    got = _frame(windows.sales_rank(df))
    want = _expected(pdf).groupby("first_category_id")[Y].rank(method="dense", ascending=False)
    _same(got["product_sales_rank"], want)


def test_dense_rank_null_key_and_ties(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 5.0), (1, -2.0), (1, 0.0), (1, None), (None, 3.0)], "k long, v double")
    out = {(r.k, r.v): r.r for r in ranks.dense_rank_desc(df, ["k"], "v", "r").collect()}
    assert out == {(1, 5.0): 1, (1, 0.0): 2, (1, -2.0): 3, (1, None): None, (None, 3.0): None}


def test_lags_share_one_shuffle(random_series):
    """All row features of a series need one sort and one exchange."""
    _, df = random_series
    steps = windows.chain(
        windows.lag_columns(Y, (1, 2, 168)),
        windows.rolling_columns(Y, (6, 24), ("mean", "std", "min", "max"), "r_{stat}_{w}", prior=True),
    )
    plan = steps(df, KEYS, ["dt"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1


def test_long_frames_add_no_shuffle(random_series):
    _, df = random_series
    fn = windows.rolling_columns(Y, (168,), ("mean", "std", "min", "max"), "r_{stat}_{w}", prior=True)
    plan = fn(df, KEYS, ["dt"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_full_pipeline_same_on_blocks(spark, sf_dir):
    from checks import inputs

    df = inputs.sales(spark, sf_dir).filter("product_id < 3")
    a = _frame(features.features_full(df))
    b = _frame(features.features_full(df, hot_rows=100))
    pd.testing.assert_frame_equal(a, b[a.columns], check_exact=False, rtol=1e-9)


def test_history_gives_first_lags(spark):
    rows = [(1, 1, h, float(h)) for h in range(10)]
    df = spark.createDataFrame(rows, "store_id long, product_id long, h int, sale_amount double")
    df = df.withColumn("dt", F.timestamp_add("HOUR", F.col("h"), F.lit("2024-01-01").cast("timestamp")))
    past, future = df.filter("h < 7"), df.filter("h >= 7")
    got = _frame(features.features_model(future, (1, 3), history=past))
    assert got[f"{Y}_lag_1"].tolist() == [6, 7, 8] and got[f"{Y}_lag_3"].tolist() == [4, 5, 6]
    alone = _frame(features.features_model(future, (1, 3)))
    assert alone[f"{Y}_lag_1"].tolist() == [0, 7, 8]


def test_cut_series_use_no_pairwise_join(random_series):
    _, df = random_series
    for out in (windows.lag_features(df, hot_rows=0), windows.ewm_prior(df, hot_rows=0), series.with_position(df, KEYS, hot_rows=0)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_basic_pipeline_with_every_step(spark, sf_dir):
    from checks import inputs

    df = inputs.sales(spark, sf_dir).filter("product_id < 2")
    out = features.features_all(df)
    assert out.count() == df.count() and set(df.columns) <= set(out.columns)
    got, want = _frame(out), _frame(df)
    _same(got[f"{Y}_lag_21"], want.groupby(KEYS)[Y].shift(21))
    _same(got["stockout_lag_7"], want.groupby(KEYS)["hours_stock_status"].shift(7))
    assert "stockout_lag_14" not in got
    _same(got[f"{Y}_rolling_max_168"], want.groupby(KEYS)[Y].transform(lambda x: x.rolling(168, min_periods=1).max()))
    assert got["store_product_count"].nunique() == 1 and got["temp_hour_interaction"].notna().all()


def test_lag_rolling_pipeline_same_on_blocks(random_series):
    _, df = random_series
    a = _frame(features.lag_rolling(df, (1, 5), (6, 40)))
    b = _frame(features.lag_rolling(df, (1, 5), (6, 40), hot_rows=50))
    pd.testing.assert_frame_equal(a, b[a.columns], check_exact=False, rtol=1e-9, atol=1e-9)
    assert not a.filter(regex="lag_|roll_|ewm_").isna().any().any()


def test_ewm_over_a_long_gap(spark):
    """The weight of the last value shrinks with all the rows of a gap, however small the blocks."""
    start = pd.Timestamp("2024-01-01")
    y = [5.0] + [None] * 60 + [9.0, 2.0]
    pdf = pd.DataFrame({"store_id": 1, "product_id": 1, "dt": [start + pd.Timedelta(hours=h) for h in range(len(y))], "sale_amount": y})
    rows = [(1, 1, r.dt.to_pydatetime(), None if pd.isna(r.sale_amount) else r.sale_amount) for r in pdf.itertuples()]
    df = spark.createDataFrame(rows, "store_id long, product_id long, dt timestamp, sale_amount double")
    got = windows.ewm_prior(df, (400,), hot_rows=0, block_rows=7).orderBy("dt").toPandas()["sale_amount_ewm_400"]
    want = pdf["sale_amount"].shift(1).ewm(span=400, adjust=False).mean()
    np.testing.assert_allclose(got.to_numpy("float64"), want.to_numpy("float64"))


def test_hot_plans_do_not_multiply(spark, sf_dir, monkeypatch):
    """With every key hot, each step reads a written table once more, whatever stands before it."""
    from checks import inputs

    df = inputs.sales(spark, sf_dir)

    def shuffles(out):
        return out._jdf.queryExecution().optimizedPlan().toString().count("Window ")

    cold = shuffles(features.features_full(df))
    monkeypatch.setattr(series, "HOT_ROWS", 5)
    monkeypatch.setattr(series, "BROADCAST_KEYS", 0)
    assert shuffles(features.features_full(df, hot_rows=5)) <= 2 * cold
