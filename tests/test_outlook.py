"""Horizons, hierarchies, trends, substitutes, calendar breaks, lasting bias and clusters against plain Python."""

from __future__ import annotations

import datetime as dt
import random

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelftide.operators import affinity, clusters, groups, periods, quantiles, ranks, regression, residuals, windows
from shelftide.plans import hierarchy, horizons

START = dt.datetime(2024, 1, 1)
SERIES = ["store_id", "product_id"]


def hours(n):
    return START + dt.timedelta(hours=n)


# --- trends ------------------------------------------------------------------

@pytest.mark.parametrize("prior", [True, False])
def test_trend_equals_a_fit_per_row(spark, random_series, prior):
    pdf, df = random_series
    got = windows.rolling_trend(df, (3, 7, 48), prior=prior).toPandas()
    for (s, p), g in got.groupby(SERIES):
        g = g.sort_values("dt").reset_index(drop=True)
        y = g["sale_amount"].to_numpy("float64")
        for w in (3, 7, 48):
            found = g[f"sale_amount_{'roll' if prior else 'rolling'}_slope_{w}"].to_numpy("float64")
            for i in range(len(y)):
                part = y[max(i - w, 0):i] if prior else y[max(i - w + 1, 0):i + 1]
                known = ~np.isnan(part)
                if known.sum() < (w if prior else 2):
                    assert np.isnan(found[i])
                else:
                    assert found[i] == pytest.approx(np.polyfit(np.flatnonzero(known), part[known], 1)[0], abs=1e-8)


def test_trend_of_cut_series(spark, random_series):
    _, df = random_series
    whole, cut = (
        {tuple(r[:2]) + (r["dt"],): r[-2:] for r in windows.rolling_trend(df, (5, 24), **hot).select(*SERIES, "dt", "sale_amount_roll_slope_5", "sale_amount_roll_slope_24").collect()}
        for hot in ({}, {"hot_rows": 60, "block_rows": 50}))
    assert whole.keys() == cut.keys()
    for k, v in whole.items():
        assert cut[k] == pytest.approx(v, abs=1e-9, nan_ok=True) if None not in v else [x is None for x in cut[k]] == [x is None for x in v]


@pytest.mark.parametrize("fn", [windows.rolling_prior, windows.rolling_incl])
def test_quantiles_of_cut_series(spark, random_series, fn):
    _, df = random_series
    whole, cut = (
        sorted(map(tuple, fn(df, (5, 30), stats=("median", "q25", "mean"), **hot).collect()), key=str) for hot in ({}, {"hot_rows": 60, "block_rows": 50}))
    assert len(whole) == len(cut)
    for a, b in zip(whole, cut, strict=True):
        assert a[:6] == b[:6] and all(x is None and y is None or x == pytest.approx(y, abs=1e-9) for x, y in zip(a[6:], b[6:], strict=True))


@pytest.mark.parametrize("odd", [-1e12, 1e12, None])
def test_ranks_beside_an_outlier(spark, odd):
    values = [float(v // 2) for v in range(4000)] + [odd, -0.0]
    df = spark.createDataFrame([(1, v) for v in values], "c int, y double").repartition(4)
    got = {(r["y"], r["r"]) for r in ranks.dense_rank_desc(df, ["c"], "y", "r").collect()}
    order = sorted({v for v in values if v is not None}, reverse=True)
    assert got == {(v, k + 1) for k, v in enumerate(order)} | ({(None, None)} if odd is None else set())
    middle = df.agg(F.percentile_approx("y", 0.5, 1000)).first()[0]
    assert df.groupBy(quantiles.magnitude_bucket(F.col("y") - F.lit(middle))).count().agg(F.max("count")).first()[0] < 20


def test_products_of_a_cell(spark):
    rows = [(1, hours(0), p) for p in (1, 1, 2, 3, None)] + [(1, hours(1), 1), (None, hours(0), 1), (None, hours(0), 2)]
    got = groups.complementary_count(spark.createDataFrame(rows, "store_id long, dt timestamp, product_id long")).collect()
    assert sorted((str(r["store_id"]), r["dt"], r["comp_products_count"]) for r in got) == sorted(
        [("1", hours(0), 2)] * 5 + [("1", hours(1), 0)] + [("None", hours(0), 1)] * 2)


# --- regression ----------------------------------------------------------------

def test_fits_per_group(spark):
    rng = np.random.default_rng(3)
    rows, want = [], {}
    for g in range(4):
        x = rng.normal(5, 2, (60, 3))
        x[:, 2] = 2 * x[:, 0] if g == 3 else x[:, 2]
        y = 1.5 + x @ [0.5, -2.0, 3.0] + rng.normal(0, 0.1, 60)
        rows += [(g, float(v), *map(float, xs)) for v, xs in zip(y, x)]
        used = x if g < 3 else x[:, :2]
        w = np.linalg.lstsq(np.column_stack([used, np.ones(60)]), y, rcond=None)[0]
        want[g] = [*w[:-1], *([0.0] if g == 3 else []), w[-1]]
    rows.append((9, None, 1.0, 1.0, 1.0))
    rows.append((8, 2.0, 1.0, 1.0, 1.0))
    df = spark.createDataFrame(rows, "g int, y double, a double, b double, c double")
    got = {r["g"]: r for r in regression.solved(regression.moments(df, ["g"], "y", ["a", "b", "c"]), 3).collect()}
    assert set(got) == {0, 1, 2, 3, 8}
    for g, w in want.items():
        assert [got[g][c] for c in ("w0", "w1", "w2", "intercept")] == pytest.approx(w, abs=1e-6)
    # One row says nothing: weights 0.
    assert [got[8][c] for c in ("w0", "w1", "w2", "intercept", "r2")] == [0, 0, 0, 2.0, None]


# --- horizons -------------------------------------------------------------------

def test_only_what_is_known_at_the_origin(spark, random_series):
    pdf, df = random_series
    got = horizons.origin_rows(df, (1, 5)).collect()
    by_key = {(r["store_id"], r["product_id"], r["dt"], r["horizon"]): r for r in got}
    expected = 0
    for (s, p), g in pdf.groupby(SERIES):
        g = g.sort_values("dt").reset_index(drop=True)
        y = g["sale_amount"].to_numpy("float64")
        for i, when in enumerate(g["dt"]):
            for h in (1, 5):
                if i < h:
                    continue
                expected += 1
                r = by_key[s, p, when.to_pydatetime(), h]
                o = i - h
                assert r["origin"] == g["dt"][o].to_pydatetime()
                for name, back in (("last", h), ("day", 24), ("week", 168)):
                    want = y[i - back] if i >= back else np.nan
                    assert r[name] is None if np.isnan(want) else r[name] == want
                for name, w in (("mean_day", 24), ("mean_week", 168)):
                    part = y[o - w + 1:o + 1] if o + 1 >= w else np.array([np.nan])
                    want = np.nan if np.isnan(part).all() else np.nanmean(part)
                    assert r[name] is None if np.isnan(want) else r[name] == pytest.approx(want, abs=1e-9)
    assert len(got) == expected


def test_horizons_of_cut_series(spark, random_series):
    _, df = random_series
    split = F.lit(hours(300)).cast("timestamp")
    whole, cut = (
        sorted(map(tuple, horizons.horizon_forecasts(df, split, (1, 5), **hot).filter("model <> 'direct'").collect()), key=str)
        for hot in ({}, {"hot_rows": 100, "block_rows": 90}))
    assert whole == cut and whole


def test_horizon_metrics_by_hand(spark):
    rows = [(1, "m", 3.0, 1.0), (1, "m", 1.0, 2.0), (6, "m", 5.0, None), (6, "m", None, 1.0), (6, "m", 4.0, 4.0)]
    df = spark.createDataFrame(rows, "horizon int, model string, sale_amount double, prediction double")
    got = {r["horizon"]: r for r in horizons.horizon_metrics(df).collect()}
    assert (got[1]["n"], got[1]["mae"], got[1]["bias"]) == (2, 1.5, -0.5) and got[1]["rmse"] == pytest.approx(2.5**0.5)
    assert (got[6]["n"], got[6]["mae"]) == (1, 0.0)


# --- hierarchy -------------------------------------------------------------------

def _sales(spark, n_hours=504, seed=4):
    rng = random.Random(seed)
    rows = []
    for s in (1, 2, 3):
        for p in (1, 2, 3, 4, 5):
            for h in range(n_hours):
                rows.append((s, p % 2, p, hours(h), round(rng.choice([0.0, 0.0, 1.0, 7.0001, 33.3333]) * s, 4) if s < 3 else 0.0))
    rows += [(4, 0, 9, hours(0), 5.0), (1, 1, 1, None, 5.0), (None, 0, 2, hours(200), 2.5), (2, 0, 2, hours(201), None)]
    return spark.createDataFrame(rows, "store_id long, first_category_id long, product_id long, dt timestamp, sale_amount double")


def test_levels_add_up_to_the_last_unit(spark):
    got = hierarchy.hierarchy_forecast(_sales(spark), F.lit(hours(336)).cast("timestamp")).toPandas()
    assert set(got["level"]) == set(hierarchy.LEVELS)
    assert got["dt"].nunique() == 168
    by = {name: g for name, g in got.groupby("level")}
    for method in ("actual", "bottom_up", "top_down"):
        total = by["total"].set_index("dt")[method].sort_index()
        for name in by:
            assert (by[name].groupby("dt")[method].sum() == total).all()
        store = by["store_category"].groupby(["store_id", "dt"], dropna=False)[method].sum()
        own = by["store"].groupby(["store_id", "dt"], dropna=False)[method].sum()
        assert (store == own).all()
    assert (by["total"]["top_down"] == by["total"]["base"]).all()
    assert (by["store_product"]["bottom_up"] == by["store_product"]["base"]).all()
    assert (got[["base", "bottom_up", "top_down"]] >= 0).all().all()
    assert (by["store"]["base"] != by["store"]["bottom_up"]).any()
    # A store that sold nothing is dealt nothing.
    assert (by["store"][by["store"]["store_id"] == 3]["top_down"] == 0).all()


def test_hierarchy_without_rows(spark):
    empty = _sales(spark).limit(0)
    assert hierarchy.hierarchy_forecast(empty, F.lit(hours(336)).cast("timestamp")).count() == 0


# --- substitutes -----------------------------------------------------------------

@pytest.mark.parametrize("chunk", [256, 2])
@pytest.mark.parametrize("support", [1, 20])
def test_pairs_equal_a_matrix(spark, monkeypatch, chunk, support):
    monkeypatch.setattr(affinity, "CHUNK", chunk)
    rng = random.Random(8)
    rows, table = [], {}
    for s in (1, 2):
        for h in range(60):
            for p in range(9):
                y = rng.choice([0.0, 0.0, None, 2.5, 4.0]) if p < 8 else 0.0
                rows.append((p % 2, s, hours(h), p, y))
                table.setdefault(p, []).append(y or 0.0)
    rows += [(0, 1, hours(0), None, 9.0), (None, 1, hours(0), 3, 9.0), (0, 1, None, 2, 9.0)]
    df = spark.createDataFrame(rows, "first_category_id long, store_id long, dt timestamp, product_id long, sale_amount double").repartition(5)
    got = {(r["product_a"], r["product_b"]): (r["first_category_id"], r["support"], r["correlation"]) for r in affinity.substitutability(df, support).collect()}
    want = {}
    for a in table:
        for b in table:
            if a < b and a % 2 == b % 2:
                x, z = np.array(table[a]), np.array(table[b])
                if (n := int(((x != 0) & (z != 0)).sum())) >= support:
                    want[a, b] = (a % 2, n, np.corrcoef(x, z)[0, 1])
    assert got.keys() == want.keys()
    for k, (c, n, r) in want.items():
        assert got[k][:2] == (c, n) and got[k][2] == pytest.approx(r, abs=1e-8)


def test_a_discount_that_takes_sales_away(spark):
    rng = random.Random(2)
    rows = []
    for h in range(200):
        d = {p: rng.choice([0.0, 0.1, 0.2]) for p in (1, 2)}
        rows.append((0, 1, hours(h), 1, 10 + 20 * d[1] - 30 * d[2], d[1]))
        rows.append((0, 1, hours(h), 2, 5 + 10 * d[2] - 1 * d[1], d[2]))
    df = spark.createDataFrame(rows, "first_category_id long, store_id long, dt timestamp, product_id long, sale_amount double, discount double")
    got = {r["product_id"]: r for r in affinity.cannibalization(df).collect()}
    assert (got[1]["substitute_id"], got[2]["substitute_id"]) == (2, 1)
    assert [got[1][c] for c in ("own_effect", "cross_effect", "intercept", "r2")] == pytest.approx([20, -30, 10, 1], abs=1e-6)
    assert got[1]["cannibalized"] and got[2]["cross_effect"] == pytest.approx(-1, abs=1e-6)


# --- calendar breaks --------------------------------------------------------------

def test_breaks_are_merged_and_found(spark):
    rng = random.Random(6)
    day = lambda k: START + dt.timedelta(days=k)
    spans = [(c, day(a), day(a + rng.randint(0, 50))) for c in (1, 2) for a in (rng.randint(0, 300) for _ in range(8))]
    bad = [(None, day(0), day(5)), (1, day(9), day(3)), (1, None, day(3)), (3, day(400), day(401))]
    calendar = spark.createDataFrame([*spans, *bad], "city_id long, start timestamp, end timestamp")
    merged = periods.merged_periods(calendar).collect()
    for c in (1, 2):
        own = sorted([r for r in merged if r["city_id"] == c], key=lambda r: r["start"])
        assert all(a["end"] < b["start"] for a, b in zip(own, own[1:]))
    rows = [(c, START + dt.timedelta(hours=7 * k)) for c in (1, 2, 3, None) for k in range(1300)] + [(1, None)]
    got = periods.in_periods(spark.createDataFrame(rows, "city_id long, dt timestamp"), calendar)
    plan = got._sc._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "simple")
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    found = got.collect()
    assert len(found) == len(rows)
    for r in found:
        inside = [m for m in merged if m["city_id"] == r["city_id"] and r["dt"] and m["start"] <= r["dt"] <= m["end"]]
        plain = any(c == r["city_id"] and r["dt"] and a <= r["dt"] <= b for c, a, b in spans)
        assert r["school_break"] == len(inside) == int(plain)
        if inside:
            assert r["school_hours_since"] == (r["dt"] - inside[0]["start"]).total_seconds() / 3600
            assert r["school_hours_left"] == (inside[0]["end"] - r["dt"]).total_seconds() / 3600


# --- residuals ---------------------------------------------------------------------

def _stepwise(r, slack, limit):
    up = down = 0.0
    out = []
    for x in r:
        before = up, down
        up, down = max(0.0, up + x - slack), max(0.0, down - x - slack)
        out.append((up, down, 1 if up > limit >= before[0] and limit else -1 if down > limit >= before[1] and limit else 0))
    return out


@pytest.mark.parametrize("hot", [{}, {"hot_rows": 20, "block_rows": 17}])
def test_cumulative_sums_equal_a_loop(spark, hot):
    rng = np.random.default_rng(1)
    rows = []
    for s, n in ((1, 300), (2, 40), (3, 1)):
        r = np.round(rng.normal(0, 3, n), 4)
        r[n // 2:] += 4 if s == 1 else 0
        rows += [(s, 1, hours(k), None if k == 3 else float(v)) for k, v in enumerate(r)]
    df = spark.createDataFrame(rows, "store_id long, product_id long, dt timestamp, residual double").repartition(3)
    got = residuals.cumulative_bias(df, **hot).toPandas()
    assert len(got) == len(rows)
    for _, g in got.groupby("store_id"):
        g = g.sort_values("dt")
        r = g["residual"].fillna(0).to_numpy("float64")
        spread = np.nanstd(g["residual"].to_numpy("float64"))
        want = _stepwise(r, round(0.5 * spread, 4), round(5 * spread, 4))
        assert g["cusum_up"].tolist() == pytest.approx([w[0] for w in want], abs=1e-6)
        assert g["cusum_down"].tolist() == pytest.approx([w[1] for w in want], abs=1e-6)
        assert g["cusum_alarm"].tolist() == [w[2] for w in want]
    assert got["cusum_alarm"].abs().sum() > 0


def test_autocorrelation(spark):
    rng = np.random.default_rng(2)
    x = np.convolve(rng.normal(0, 1, 400), [1, 0.8, 0.5], "same")
    df = spark.createDataFrame([(1, 1, hours(k), float(v)) for k, v in enumerate(x)] + [(2, 1, hours(0), 1.0)], "store_id long, product_id long, dt timestamp, residual double")
    got = {r["store_id"]: r for r in residuals.autocorrelation(df, (1, 3)).collect()}
    m = x - x.mean()
    for k in (1, 3):
        assert got[1][f"acf_{k}"] == pytest.approx((m[k:] * m[:-k]).sum() / (m * m).sum(), abs=1e-9)
    assert got[2]["acf_1"] is None and got[1]["bias"] == pytest.approx(x.mean())


# --- clusters -----------------------------------------------------------------------

def test_clusters_are_the_nearest_stored_centres(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = []
    for s in range(40):
        for h in range(168):
            busy = h % 24 in ((8, 9, 10) if s % 3 == 0 else (17, 18, 19) if s % 3 == 1 else (0, 1))
            rows.append((s, 1, hours(h), round(float(rng.uniform(0, 1) + 20 * busy), 4)))
    rows += [(99, 1, hours(3), 0.0), (None, 1, hours(3), 1.0), (5, 1, None, 1.0), (98, 1, hours(3), None)]
    profiles = clusters.week_profiles(spark.createDataFrame(rows, "store_id long, product_id long, dt timestamp, sale_amount double").repartition(4))
    model = clusters.fit_store_clusters(profiles, k=4)
    again = clusters.fit_store_clusters(profiles, k=4)
    assert model.centres == again.centres
    found = model.transform(profiles)
    found.write.parquet(f"{tmp_path}/found")
    model.centre_rows(spark).write.parquet(f"{tmp_path}/centres")
    bad = duckdb.sql(f"""
        WITH f AS (SELECT * FROM '{tmp_path}/found/*.parquet'), c AS (SELECT * FROM '{tmp_path}/centres/*.parquet'),
        d AS (SELECT store_id, f.cluster AS got, distance, c.cluster, list_distance(profile, centre) AS d FROM f CROSS JOIN c)
        SELECT count(*) FILTER (n <> got OR abs(d - distance) > 1e-9) FROM (SELECT store_id, any_value(got) AS got, any_value(distance) AS distance,
          arg_min(cluster, (round(d, 12), cluster)) AS n, min(d) AS d FROM d GROUP BY store_id)""").fetchall()[0][0]
    assert bad == 0
    got = {r["store_id"]: r["cluster"] for r in found.collect()}
    assert len(got) == 42 and got[98] == got[99]
    for kind in range(3):
        assert len({got[s] for s in range(40) if s % 3 == kind}) == 1
    assert len({got[s] for s in (0, 1, 2, 99)}) == 4
    assert clusters.fit_store_clusters(profiles.limit(0)).centres == []
    few = clusters.fit_store_clusters(profiles.filter("store_id IN (1, 98, 99)"), k=4)
    assert len(few.centres) == 2 and few.centres[0] == [0.0] * 168
    assert {r["distance"] for r in few.transform(profiles.filter("store_id IN (1, 99)")).collect()} == {0.0}
