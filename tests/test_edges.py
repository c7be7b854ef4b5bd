"""Edges of bins, bands, calendar parts and group statistics."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelftide.operators import bins, calendar, groups, prep, profile, views
from shelftide.plans import questions
from shelftide.sources import sales

EMPTY = dict(
    city_id=1, store_id=1, product_id=1, first_category_id=1, second_category_id=1, third_category_id=1,
    dt=dt.datetime(2024, 1, 3, 10), sale_amount=1.0, hours_stock_status=1, discount=0.0, holiday_flag=0,
    activity_flag=0, precpt=0.0, avg_temperature=15.0, avg_humidity=50.0, avg_wind_level=1.0,
)


def make(spark, *rows):
    from shelftide.schema import SALES_SCHEMA

    full = [{**EMPTY, **r} for r in rows]
    return spark.createDataFrame([tuple(r[f.name] for f in SALES_SCHEMA) for r in full], SALES_SCHEMA)


def _labels(df, key, label):
    return {r[key]: r[label] for r in df.collect()}


def test_temperature_bins_are_right_closed(spark):
    t = [-5.0, 10.0, 10.0001, 25.0, 25.0001, None]
    out = _labels(bins.temp_category(make(spark, *[{"avg_temperature": v} for v in t])), "avg_temperature", "temp_category")
    assert out == {-5.0: "cold", 10.0: "cold", 10.0001: "mild", 25.0: "mild", 25.0001: "hot", None: None}


def test_precipitation_bins(spark):
    p = [-1.0, 0.0, 0.1, 2.0, 5.0, 5.1, None]
    out = _labels(bins.precip_category(make(spark, *[{"precpt": v} for v in p])), "precpt", "precip_category")
    assert list(out.values()) == ["none", "none", "light", "light", "moderate", "heavy", None]


@pytest.mark.parametrize("scale, unit", [(100.0, 0.01), (1.0, 1.0)])
def test_discount_bins_in_both_units(spark, scale, unit):
    d = [0.0, 5 * unit, 10 * unit, 15 * unit, 20 * unit, 25 * unit]
    df = bins.discount_category(make(spark, *[{"discount": v} for v in d]), scale=scale)
    assert [r.discount_category for r in df.orderBy("discount").collect()] == [
        "none", "small", "small", "medium", "medium", "large"]


def test_question_temperature_bands_have_gaps(spark):
    t = [9.9, 10.0, 20.0, 20.5, 21.0, 30.0, 30.5, None]
    hb = views.hourly_business(make(spark, *[{"avg_temperature": v} for v in t]))
    out = _labels(hb.withColumn("band", questions.temperature_range()), "avg_temperature", "band")
    assert list(out.values()) == ["cold", "mild", "mild", "hot", "warm", "warm", "hot", "hot"]


def test_question_discount_bands_have_gaps(spark):
    d = [-0.1, 0.0, 0.005, 0.01, 0.10, 0.105, 0.11, 0.20, 0.21, None]
    hb = views.hourly_business(make(spark, *[{"discount": v} for v in d]))
    out = _labels(hb.withColumn("band", questions.discount_range()), "discount", "band")
    assert list(out.values()) == [
        "21%+", "0%", "21%+", "1-10%", "1-10%", "21%+", "11-20%", "11-20%", "21%+", "21%+"]


def test_stockout_flag_never_meets_a_sale(spark):
    hb = views.hourly_business(make(
        spark, {"sale_amount": 0.0, "activity_flag": 1}, {"sale_amount": 0.0}, {"activity_flag": 1}, {"sale_amount": None}))
    assert sorted(r.stockout_flag for r in hb.collect()) == [0, 0, 0, 1]
    assert questions.promo_stockout(hb).count() == 0
    avg = {r.stockout_flag: r.avg_sales for r in questions.stock_avg(hb).collect()}
    assert avg == {1: 0.0, 0: 0.5}


def test_activity_levels(spark):
    rows = [{"dt": dt.datetime(2024, 1, 1 + i, 5), "sale_amount": v} for i, v in enumerate([4.99, 5.0, 15.0, 15.01])]
    out = views.rhythm_patterns(views.hourly_business(make(spark, *rows)))
    assert {r.avg_sales: r.activity_level for r in out.collect()} == {
        4.99: "Low Activity", 5.0: "Medium Activity", 15.0: "Medium Activity", 15.01: "High Activity"}


def test_weather_null_is_clear(spark):
    assert views.hourly_business(make(spark, {"precpt": None})).first().weather == "clear"


def test_store_health_null_score_last(spark):
    hb = views.hourly_business(make(
        spark, {"store_id": 1, "sale_amount": 100.0}, {"store_id": 2}, {"store_id": 2, "dt": dt.datetime(2024, 1, 4)}))
    assert [r.store_id for r in questions.store_health(hb).collect()] == [2, 1]


def test_potential_increase_adds_up(spark):
    hb = views.hourly_business(make(
        spark,
        {"product_id": 1, "sale_amount": 4.0}, {"product_id": 1, "sale_amount": 6.0},
        {"product_id": 1, "sale_amount": 0.0, "activity_flag": 1},
        {"product_id": 2, "sale_amount": 0.0, "activity_flag": 1}, {"product_id": None, "sale_amount": 9.0}))
    r = questions.potential_increase(hb).first()
    # The second product never had stock, so nothing is known about what it could sell.
    assert (r.actual_sales, r.potential_sales, r.potential_increase) == (10.0, 15.0, 5.0)


def test_calendar_parts_and_weekday_bases(spark):
    days = [dt.datetime(2024, 12, 30, 0), dt.datetime(2024, 1, 7, 22), dt.datetime(2024, 1, 8, 9)]
    df = calendar.weekend_flags(calendar.calendar_parts(make(spark, *[{"dt": d} for d in days])))
    out = {r.dt: r for r in df.collect()}
    assert (out[days[0]].week_of_year, out[days[0]].quarter, out[days[0]].month) == (1, 4, 12)
    assert (out[days[1]].day_of_week, out[days[1]].is_weekend, out[days[1]].is_weekday) == (6, 1, 0)
    assert out[days[2]].day_of_week == 0
    hb = {r.dt: r.day_of_week for r in views.hourly_business(make(spark, *[{"dt": d} for d in days])).collect()}
    assert hb[days[1]] == 0 and hb[days[2]] == 1


def test_day_parts_include_their_limits(spark):
    hours = [0, 5, 6, 7, 9, 10, 11, 14, 17, 20, 21, 22]
    df = calendar.day_parts(calendar.calendar_parts(make(spark, *[{"dt": dt.datetime(2024, 1, 1, h)} for h in hours])))
    got = {r.hour: (r.is_morning_rush, r.is_lunch_time, r.is_evening_rush, r.is_late_night) for r in df.collect()}
    assert got[5] == (0, 0, 0, 1) and got[6] == (0, 0, 0, 0) and got[9] == (1, 0, 0, 0)
    assert got[14] == (0, 1, 0, 0) and got[20] == (0, 0, 1, 0) and got[22] == (0, 0, 0, 1)


def test_trend_counts_whole_days(spark):
    start = dt.datetime(2024, 1, 1, 12)
    df = calendar.trend(make(spark, {"dt": start}, {"dt": start + dt.timedelta(hours=37)}))
    r = df.orderBy(F.desc("dt")).first()
    assert (r.days_since_start, r.hours_since_start) == (1, 37.0)


def test_condition_flags_treat_unknown_as_false(spark):
    df = make(spark, {"avg_temperature": None, "precpt": None, "discount": None})
    df = bins.precip_category(bins.temp_category(calendar.calendar_parts(df)))
    r = bins.rainy_morning_discount(bins.hot_weekend_afternoon(df)).first()
    assert (r.hot_weekend_afternoon, r.rainy_morning_discount) == (0, 0)


def test_group_means_round_half_to_even(spark):
    rows = [{"store_id": 1, "sale_amount": v} for v in (0.25, 0.0)] + [{"store_id": 2, "sale_amount": v} for v in (0.75, 0.0)]
    out = {r.store_id: r.store_avg_sales for r in groups.store_stats(make(spark, *rows)).collect()}
    assert out == {1: 0.12, 2: 0.38}


def test_statistics_keep_every_row(spark):
    df = make(spark, {"store_id": None}, {"store_id": 2}, {"product_id": None})
    out = groups.categorical_features(df)
    assert out.count() == 3
    assert out.filter("store_id is null").first().store_avg_sales is None


def test_broadcast_depends_on_the_number_of_keys(spark, monkeypatch):
    from shelftide.operators import series

    df = make(spark, {"store_id": 1}, {"store_id": 2})
    plan = groups.store_stats(df)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    monkeypatch.setattr(series, "BROADCAST_KEYS", 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = groups.store_stats(df)
        assert "SortMergeJoin" in big._jdf.queryExecution().executedPlan().toString()
        assert big.count() == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_keys_join_apart_from_the_rest(spark, monkeypatch):
    from shelftide.operators import series

    rows = [{"store_id": 1}] * 9 + [{"store_id": None}] * 7 + [{"store_id": s, "sale_amount": float(s)} for s in (2, 3, 4)]
    df = make(spark, *rows)
    want = sorted(groups.store_stats(df).select("store_id", "store_max_sales", "store_product_count").collect(), key=str)
    monkeypatch.setattr(series, "BROADCAST_KEYS", 1)
    monkeypatch.setattr(series, "HOT_ROWS", 5)
    got = groups.store_stats(df)
    assert sorted(got.select("store_id", "store_max_sales", "store_product_count").collect(), key=str) == want
    assert got.columns == groups.store_stats(df).columns and got.count() == len(rows)


def test_last_rows_are_pruned_before_the_shuffle(spark, sf_dir):
    from checks import inputs

    from shelftide.forecast.naive import Naive

    table = Naive("seasonal", 24).fit(inputs.train(spark, sf_dir)).table
    assert "WindowGroupLimit" in table._jdf.queryExecution().executedPlan().toString()


def test_finite_values(spark):
    rows = [(float("nan"),), (float("inf"),), (float("-inf"),), (None,), (2.5,)]
    out = prep.finite_clean(spark.createDataFrame(rows, "x double"), ["x"])
    assert sorted(r.x for r in out.collect()) == [-1e10, 0.0, 0.0, 2.5, 1e10]


def test_scaling_of_a_constant_column(spark):
    df = spark.createDataFrame([(3.0, 1.0), (3.0, 2.0)], "a double, b double")
    for method in ("standard", "robust"):
        assert {r.a for r in prep.scale(df, df, ["a", "b"], method).collect()} == {0.0}


def test_median_of_an_even_count(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    assert prep.medians(df, ["x"]).first().x == 2.5
    assert {r.x for r in prep.impute_median(df, df, ["x"]).collect()} == {1.0, 2.0, 2.5, 3.0, 10.0}


def test_split_is_stable_and_near_its_share(spark, sf_dir):
    from checks import inputs

    df = inputs.sales(spark, sf_dir)
    train, held = prep.train_val_split(df)
    n, k = df.count(), held.count()
    assert train.count() + k == n and abs(k / n - 0.2) < 0.03
    again = prep.train_val_split(df.repartition(3))[1]
    assert again.select("store_id", "product_id", "dt").exceptAll(held.select("store_id", "product_id", "dt")).count() == 0


def test_outlier_of_constant_sales(spark):
    out = profile.outlier_flag(make(spark, {}, {}, {}))
    assert {(r.sale_zscore, r.outlier_flag) for r in out.collect()} == {(None, False)}


def test_validate_input(spark):
    with pytest.raises(ValueError, match="empty"):
        profile.validate_input(make(spark).limit(0))
    with pytest.raises(ValueError, match="rows"):
        profile.validate_input(make(spark, {}), make(spark, {}, {}))
    report = profile.validate_input(make(spark, {"precpt": None}, {"sale_amount": None, "precpt": None}), "sale_amount")
    issues = {r["column"]: r.issue for r in report.collect()}
    assert issues["precpt"] == "mostly null" and issues["sale_amount"] == "null target" and issues["dt"] == "ok"


def test_fill_leaves_keys_alone(spark):
    df = make(spark, {"store_id": None, "discount": None})
    r = bins.fill_all_zero(df, keep=["store_id"]).first()
    assert r.store_id is None and r.discount == 0.0
    assert bins.fill_features(df, ["absent"]).first().discount is None


def test_csv_round_trip_and_nan(spark, tmp_path):
    df = make(spark, {"sale_amount": float("nan")}, {"store_id": 2, "sale_amount": 3.25})
    path = str(tmp_path / "sales")
    df.write.option("header", True).csv(path)
    back = sales.read_csv(spark, path)
    assert back.schema == df.schema
    assert {r.sale_amount for r in back.collect()} == {None, 3.25}


def test_train_eval_sample_keeps_whole_series(spark, tmp_path, sf_dir):
    from checks import inputs

    a, b = str(tmp_path / "a.parquet"), str(tmp_path / "b.parquet")
    inputs.train(spark, sf_dir).write.parquet(a)
    inputs.evaluation(spark, sf_dir).write.parquet(b)
    train, ev = sales.read_train_eval(spark, a, b, fraction=0.5)
    sizes = {r["count"] for r in train.groupBy("store_id", "product_id").count().collect()}
    assert sizes == {552}
    keys = {(r.store_id, r.product_id) for r in train.select("store_id", "product_id").distinct().collect()}
    assert keys == {(r.store_id, r.product_id) for r in ev.select("store_id", "product_id").distinct().collect()}


def test_unreadable_datetime_becomes_null(spark):
    df = spark.createDataFrame([("2024-01-01 05:00:00",), ("never",)], "dt string")
    assert [r.dt for r in sales.parse_dt(df).collect()] == [dt.datetime(2024, 1, 1, 5), None]


def test_daily_arrays_become_hours(spark):
    from shelftide.schema import DAILY_SCHEMA

    row = {**EMPTY, "dt": dt.datetime(2024, 1, 2), "hours_sale": [float(i) for i in range(24)],
           "hours_stock_status": [0] * 23 + [1]}
    daily = spark.createDataFrame([tuple(row[f.name] for f in DAILY_SCHEMA)], DAILY_SCHEMA)
    out = sales.explode_hours(daily).orderBy("dt").collect()
    assert len(out) == 24 and out[23].dt == dt.datetime(2024, 1, 2, 23)
    assert (out[5].sale_amount, out[22].hours_stock_status, out[23].hours_stock_status) == (5.0, 0, 1)


def test_repeated_hours(spark):
    df = make(spark, {"sale_amount": 1.0}, {"sale_amount": 2.5}, {"store_id": 4})
    assert [r.copies for r in sales.repeated_hours(df).collect()] == [2]
    merged = sales.merge_repeated(df)
    assert sorted(r.sale_amount for r in merged.collect()) == [1.0, 3.5] and merged.columns == df.columns


def test_sample_n_is_the_same_on_any_partitioning(spark, sf_dir):
    from checks import inputs

    df, keys = inputs.sales(spark, sf_dir), ["store_id", "product_id", "dt"]
    a = sales.sample_n(df, 20, keys).select(*keys).collect()
    assert a == sales.sample_n(df.repartition(3), 20, keys).select(*keys).collect() and len(a) == 20


def test_views_work_from_sql(spark, sf_dir):
    from checks import inputs

    views.register_views(inputs.sales(spark, sf_dir))
    n = spark.sql("select count(*) c from hourly_business where is_weekend = 1").first().c
    assert n == 12 * 24 * 8
    assert spark.sql("select * from store_dashboard").count() == 1


def test_csv_columns_are_found_by_name(spark, tmp_path):
    df = make(spark, {"store_id": 7, "sale_amount": 2.5}, {"store_id": 8, "discount": None})
    path = str(tmp_path / "permuted")
    df.select(F.lit("x").alias("note"), *reversed(df.columns)).write.option("header", True).csv(path)
    back = sales.read_csv(spark, path)
    assert back.schema == df.schema and sorted(back.collect()) == sorted(df.collect())
    df.drop("dt").write.option("header", True).csv(str(tmp_path / "short"))
    with pytest.raises(ValueError, match="dt"):
        sales.read_csv(spark, str(tmp_path / "short"))


def test_csv_text_that_is_no_value_is_null(spark, tmp_path):
    df = make(spark, {}).withColumn("discount", F.lit("much"))
    df.write.option("header", True).csv(str(tmp_path / "odd"))
    assert sales.read_csv(spark, str(tmp_path / "odd")).first()["discount"] is None
