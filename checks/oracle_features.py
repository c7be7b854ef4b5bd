"""Oracle SQL for calendar, binned, window and group features."""

from __future__ import annotations

from .sqltext import SER, ea, es, on_sales

Y = "sale_amount"
ROW = "store_id, product_id, dt"
WINDOWS = (6, 24, 168)
LAGS = (1, 2, 3, 6, 24, 48, 168)

HOUR, DOW, MONTH = "CAST(hour(dt) AS INT)", "CAST(isodow(dt) - 1 AS INT)", "CAST(month(dt) AS INT)"
PARTS = f"""parts AS (SELECT *, {HOUR} AS hour, {DOW} AS day_of_week, CAST(day(dt) AS INT) AS day_of_month,
  {MONTH} AS month, CAST(quarter(dt) AS INT) AS quarter, CAST(week(dt) AS INT) AS week_of_year FROM sales)"""


def _flag(cond: str) -> str:
    return f"CAST(CASE WHEN {cond} THEN 1 ELSE 0 END AS INT)"


def _cycle(prefix: str, value: str, n: int) -> str:
    angle = f"2 * pi() * ({value}) / {n}"
    return f"ROUND(SIN({angle}), 9) AS {prefix}_sin, ROUND(COS({angle}), 9) AS {prefix}_cos"


def _period(n: int) -> str:
    angle = f"2 * pi() * {HOUR} / {n}"
    return f"ROUND(SIN({angle}), 9) AS sin_{n}, ROUND(COS({angle}), 9) AS cos_{n}"


def _bins(c: str, bins) -> str:
    whens = " ".join(f"WHEN {c} <= {u} THEN '{label}'" for u, label in bins[:-1])
    return f"CASE WHEN {c} IS NULL THEN NULL {whens} ELSE '{bins[-1][1]}' END"


TEMP = _bins("avg_temperature", [(10, "cold"), (25, "mild"), (None, "hot")])
PRECIP = _bins("precpt", [(0, "none"), (2, "light"), (5, "moderate"), (None, "heavy")])
DISCOUNT = _bins("ROUND(discount * 100, 9)", [(0, "none"), (10, "small"), (20, "medium"), (None, "large")])


def _over(expr: str, frame: str) -> str:
    return f"{expr} OVER ({SER} ROWS BETWEEN {frame})"


def _incl(stat: str, agg: str, zero: bool = False) -> str:
    cols = []
    for w in WINDOWS:
        value = _over(agg, f"{w - 1} PRECEDING AND CURRENT ROW")
        value = f"COALESCE({value}, 0)" if zero else value
        cols.append(f"ROUND({value}, 6) AS {Y}_rolling_{stat}_{w}")
    return on_sales(f"SELECT {ROW}, {', '.join(cols)} FROM sales")


def _prior(stat: str, agg: str) -> str:
    cols = []
    for w in WINDOWS:
        frame = f"{w} PRECEDING AND 1 PRECEDING"
        cols.append(
            f"CASE WHEN {_over(f'COUNT({Y})', frame)} >= {w} THEN ROUND({_over(agg, frame)}, 6) END AS {Y}_roll_{stat}_{w}")
    return on_sales(f"SELECT {ROW}, {', '.join(cols)} FROM sales")


def _trend(prior: bool) -> str:
    cols = []
    for w in WINDOWS:
        over = f"OVER ({SER} ROWS BETWEEN {f'{w} PRECEDING AND 1 PRECEDING' if prior else f'{w - 1} PRECEDING AND CURRENT ROW'})"
        slope = f"CASE WHEN COUNT({Y}) {over} >= {w if prior else 2} THEN ROUND(REGR_SLOPE({Y}, rn) {over}, 9) END"
        cols.append(f"{slope} AS {Y}_{'roll' if prior else 'rolling'}_slope_{w}")
    return on_sales(f"SELECT {ROW}, {', '.join(cols)} FROM pl", f"pl AS (SELECT *, CAST(ROW_NUMBER() OVER ({SER}) AS DOUBLE) AS rn FROM sales)")


def _change(c: str, name: str) -> str:
    return f"ROUND(COALESCE({c} - LAG({c}) OVER ({SER}), 0), 9) AS {name}"


def _half_even(x: str) -> str:
    return f"ROUND({x}, 2)"


_EWM_ROWS = f"""ser AS (SELECT {ROW}, ROW_NUMBER() OVER ({SER}) AS rn, LAG({Y}) OVER ({SER}) AS x FROM sales),
ew AS (
  SELECT store_id, product_id, dt, rn, x AS e6, x AS e24, x AS e168 FROM ser WHERE rn = 2
  UNION ALL
  SELECT s.store_id, s.product_id, s.dt, s.rn, {', '.join(
    f'e.e{w} * (1 - CAST(2 AS DOUBLE) / {w + 1}) + s.x * (CAST(2 AS DOUBLE) / {w + 1})' for w in WINDOWS)}
  FROM ew e JOIN ser s ON s.store_id = e.store_id AND s.product_id = e.product_id AND s.rn = e.rn + 1)"""

ORACLE = {
    "calendar_parts": on_sales(
        f"SELECT {ROW}, hour, day_of_week, day_of_month, month, quarter, week_of_year FROM parts", PARTS),
    "cyclical": on_sales(
        f"SELECT {ROW}, {_cycle('hour', 'hour', 24)}, {_cycle('day_of_week', 'day_of_week', 7)}, "
        f"{_cycle('month', 'month', 12)} FROM parts", PARTS),
    "cyclical_month0": on_sales(
        f"SELECT {ROW}, {_cycle('hour', 'hour', 24)}, {_cycle('dow', 'day_of_week', 7)}, "
        f"{_cycle('month', 'month - 1', 12)} FROM parts", PARTS),
    "weekend_flags": on_sales(
        f"SELECT {ROW}, {_flag('day_of_week >= 5')} AS is_weekend, {_flag('day_of_week < 5')} AS is_weekday FROM parts", PARTS),
    "day_parts": on_sales(
        f"""SELECT {ROW}, {_flag('hour BETWEEN 7 AND 9')} AS is_morning_rush, {_flag('hour BETWEEN 11 AND 14')} AS is_lunch_time,
        {_flag('hour BETWEEN 17 AND 20')} AS is_evening_rush, {_flag('hour >= 22 OR hour <= 5')} AS is_late_night FROM parts""", PARTS),
    "trend": on_sales(
        f"""SELECT {ROW}, CAST(FLOOR(sec / 86400) AS BIGINT) AS days_since_start, ROUND(sec / 3600, 9) AS hours_since_start
        FROM (SELECT {ROW}, epoch(dt) - (SELECT epoch(MIN(dt)) FROM sales) AS sec FROM sales)"""),
    "time_interactions": on_sales(
        f"SELECT {ROW}, hour * day_of_week AS hour_dow_interaction, hour * month AS hour_month_interaction FROM parts", PARTS),
    "interactions": on_sales(
        f"""SELECT {ROW}, ROUND(avg_temperature * hour, 9) AS temp_hour_interaction,
        ROUND(precpt * {_flag('day_of_week >= 5')}, 9) AS rain_weekend_interaction,
        ROUND(discount * {_flag('day_of_week >= 5')}, 9) AS discount_weekend,
        ROUND(discount * {_flag('hour BETWEEN 17 AND 20')}, 9) AS discount_evening,
        hours_stock_status * hour AS stock_hour_interaction FROM parts""", PARTS),
    "seasonal_terms": on_sales(f"SELECT {ROW}, {_period(24)}, {_period(168)} FROM sales"),
    "temp_category": on_sales(f"SELECT {ROW}, {TEMP} AS temp_category FROM sales"),
    "precip_category": on_sales(f"SELECT {ROW}, {PRECIP} AS precip_category FROM sales"),
    "discount_category": on_sales(f"SELECT {ROW}, {DISCOUNT} AS discount_category FROM sales"),
    "hot_weekend_afternoon": on_sales(
        f"""SELECT {ROW}, {_flag(f"{TEMP} = 'hot' AND day_of_week >= 5 AND hour BETWEEN 12 AND 18")}
        AS hot_weekend_afternoon FROM parts""", PARTS),
    "rainy_morning_discount": on_sales(
        f"""SELECT {ROW}, {_flag(f"{PRECIP} = 'moderate' AND hour BETWEEN 6 AND 12 AND discount > 0")}
        AS rainy_morning_discount FROM parts""", PARTS),
    "fill_features": on_sales(f"""
        SELECT {ROW}, {Y}, COALESCE(LAG({Y}, 1) OVER ({SER}), 0) AS {Y}_lag_1,
          COALESCE(LAG({Y}, 168) OVER ({SER}), 0) AS {Y}_lag_168 FROM sales"""),
    "fill_all_zero": on_sales(f"""
        SELECT {ROW}, ROUND({Y}, 6) AS {Y},
          COALESCE(CASE WHEN rn > 6 THEN ROUND(m, 6) END, 0) AS {Y}_roll_mean_6,
          COALESCE(CASE WHEN rn > 6 THEN ROUND(s, 6) END, 0) AS {Y}_roll_std_6
        FROM (SELECT *, ROW_NUMBER() OVER ({SER}) AS rn, {_over(f'AVG({Y})', '6 PRECEDING AND 1 PRECEDING')} AS m,
                {_over(f'STDDEV_SAMP({Y})', '6 PRECEDING AND 1 PRECEDING')} AS s FROM sales)"""),
    "lag_features": on_sales(
        f"SELECT {ROW}, " + ", ".join(f"LAG({Y}, {k}) OVER ({SER}) AS {Y}_lag_{k}" for k in LAGS) + " FROM sales"),
    "stockout_lags": on_sales(
        f"SELECT {ROW}, " + ", ".join(f"LAG(hours_stock_status, {k}) OVER ({SER}) AS stockout_lag_{k}" for k in LAGS if k <= 7)
        + " FROM sales"),
    "rolling_incl_mean": _incl("mean", f"1e-9 + AVG({Y})"),
    "rolling_incl_std": _incl("std", f"STDDEV_SAMP({Y})", True),
    "rolling_incl_max": _incl("max", f"MAX({Y})"),
    "rolling_incl_median": _incl("median", f"quantile_cont({Y}, 0.5)"),
    "rolling_prior_mean": _prior("mean", f"1e-9 + AVG({Y})"),
    "rolling_prior_std": _prior("std", f"STDDEV_SAMP({Y})"),
    "rolling_prior_min": _prior("min", f"MIN({Y})"),
    "rolling_prior_max": _prior("max", f"MAX({Y})"),
    "rolling_prior_q25": _prior("q25", f"quantile_cont({Y}, 0.25)"),
    "rolling_prior_q75": _prior("q75", f"quantile_cont({Y}, 0.75)"),
    "rolling_trend": _trend(True),
    "rolling_trend_incl": _trend(False),
    "ewm_prior": on_sales(
        f"SELECT s.store_id, s.product_id, s.dt, " + ", ".join(f"ROUND(e.e{w}, 6) AS {Y}_ewm_{w}" for w in WINDOWS)
        + " FROM ser s LEFT JOIN ew e USING (store_id, product_id, rn)", _EWM_ROWS),
    "holiday_adjacent": on_sales(f"""
        SELECT {ROW}, COALESCE(LEAD(holiday_flag) OVER ({SER}), 0) AS day_before_holiday,
          COALESCE(LAG(holiday_flag) OVER ({SER}), 0) AS day_after_holiday FROM sales"""),
    "weather_change": on_sales(
        f"SELECT {ROW}, {_change('avg_temperature', 'temp_change')}, {_change('precpt', 'precip_change')} FROM sales"),
    "discount_change": on_sales(f"SELECT {ROW}, {_change('discount', 'discount_change')} FROM sales"),
    "sales_rank": on_sales(f"""
        SELECT {ROW}, DENSE_RANK() OVER (PARTITION BY first_category_id ORDER BY {Y} DESC) AS product_sales_rank FROM sales"""),
    "product_velocity": on_sales(f"""
        SELECT {ROW}, CASE WHEN COUNT({Y}) OVER w >= 7
          THEN CAST(SUM(CAST({Y} AS DECIMAL(18,4))) OVER w AS DOUBLE) ELSE 0 END AS product_velocity
        FROM sales WINDOW w AS (PARTITION BY product_id ORDER BY dt, store_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""),
    "store_stats": on_sales(
        f"SELECT {ROW}, t.* EXCLUDE (k) FROM sales JOIN t ON t.k = store_id",
        f"""t AS (SELECT store_id AS k, {_half_even(ea(Y))} AS store_avg_sales, {_half_even(f'STDDEV_SAMP({Y})')} AS store_sales_volatility,
          {_half_even(f'MAX({Y})')} AS store_max_sales, COUNT(DISTINCT product_id) AS store_product_count FROM sales GROUP BY 1)"""),
    "product_stats": on_sales(
        f"SELECT {ROW}, t.* EXCLUDE (k) FROM sales JOIN t ON t.k = product_id",
        f"""t AS (SELECT product_id AS k, {_half_even(ea(Y))} AS product_avg_sales, {_half_even(f'STDDEV_SAMP({Y})')} AS product_sales_volatility,
          COUNT(DISTINCT store_id) AS product_store_count FROM sales GROUP BY 1)"""),
    "city_stats": on_sales(
        f"SELECT {ROW}, t.* EXCLUDE (k) FROM sales JOIN t ON t.k = city_id",
        f"""t AS (SELECT city_id AS k, {_half_even(ea(Y))} AS city_avg_sales,
          {_half_even(ea('hours_stock_status'))} AS city_stock_availability FROM sales GROUP BY 1)"""),
    "store_features": on_sales(
        f"SELECT {ROW}, t.* EXCLUDE (k) FROM sales JOIN t ON t.k = store_id",
        f"""t AS (SELECT store_id AS k, {es(Y)} AS store_total_sales, COUNT(DISTINCT product_id) AS store_num_products,
          ROUND({ea(Y)}, 9) AS store_avg_sales_per_product,
          ROUND(CAST(COUNT(*) FILTER (WHERE hours_stock_status = 0) AS DOUBLE) / COUNT(*), 9) AS store_stockout_freq
          FROM sales GROUP BY 1)"""),
    "avg_discount": on_sales(
        f"""SELECT {ROW}, avg_discount_store, avg_discount_category FROM sales JOIN a ON a.k = store_id
        JOIN b ON b.k = first_category_id""",
        f"a AS (SELECT store_id AS k, ROUND({ea('discount')}, 9) AS avg_discount_store FROM sales GROUP BY 1)",
        f"b AS (SELECT first_category_id AS k, ROUND({ea('discount')}, 9) AS avg_discount_category FROM sales GROUP BY 1)"),
    "product_stage": on_sales(
        f"SELECT {ROW}, product_stage FROM sales JOIN t ON t.k = product_id",
        f"""t AS (SELECT product_id AS k, CASE WHEN {ea(Y)} <= 10 THEN 'new' WHEN {ea(Y)} <= 50 THEN 'mature'
          WHEN {ea(Y)} IS NOT NULL THEN 'declining' END AS product_stage FROM sales GROUP BY 1)"""),
    "category_spillover": on_sales(
        f"SELECT {ROW}, category_sales_sum FROM sales JOIN t ON t.k = first_category_id",
        f"t AS (SELECT first_category_id AS k, {es(Y)} AS category_sales_sum FROM sales GROUP BY 1)"),
    "complementary_count": on_sales(
        f"SELECT {ROW}, comp_products_count FROM sales JOIN t ON t.k = store_id AND t.d = dt",
        "t AS (SELECT store_id AS k, dt AS d, COUNT(DISTINCT product_id) - 1 AS comp_products_count FROM sales GROUP BY 1, 2)"),
    "city_total": on_sales(
        f"SELECT {ROW}, city_total_sales FROM sales JOIN t ON t.k = city_id",
        f"t AS (SELECT city_id AS k, {es(Y)} AS city_total_sales FROM sales GROUP BY 1)"),
}
