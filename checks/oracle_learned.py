"""Oracle SQL for models with a closed form, pipelines and model storage."""

from __future__ import annotations

from .oracle_features import DISCOUNT, LAGS, PARTS, PRECIP, TEMP, WINDOWS, _EWM_ROWS, _cycle, _flag
from .oracle_models import CORE, ORACLE as MODELS
from .oracle_profile import PREDICTIONS, key_bucket
from .sqltext import SER, SPLIT, ea, es, on_hb, on_sales, solve

Y = "sale_amount"
ROW = "store_id, product_id, dt"

# Training rows with zero-filled lags; z is the weekly lag scaled to mean 0 and spread 1.
LAGGED = f"""lagged AS (SELECT *, COALESCE(LAG({Y}, 1) OVER ({SER}), 0) AS a, COALESCE(LAG({Y}, 168) OVER ({SER}), 0) AS b
  FROM sales WHERE dt < {SPLIT}),
m AS (SELECT COVAR_POP({Y}, b) / STDDEV_POP(b) AS c, AVG({Y}) AS mean_y, CAST(COUNT(*) AS DOUBLE) AS n FROM lagged)"""


def _single(slope: str) -> str:
    return on_sales(
        f"""SELECT '{Y}_lag_168' AS feature, ROUND({slope}, 6) AS coefficient, ROUND(ABS({slope}), 6) AS importance FROM m
        UNION ALL SELECT 'intercept', ROUND(mean_y, 6), NULL FROM m""", LAGGED)


SEVEN = ("hour_sin", "hour_cos", "dow_sin", "dow_cos", f"{Y}_lag_1", f"{Y}_lag_7", f"{Y}_lag_168")
_ANGLES = {"hour": "2 * pi() * hour(dt) / 24", "dow": "2 * pi() * (isodow(dt) - 1) / 7"}


def _seven(alpha: float) -> str:
    """Normal equations over the seven features of the models, each scaled to mean 0 and spread 1."""
    raw = ", ".join(f"{f}({a}) AS {n}_{f.lower()}" for n, a in _ANGLES.items() for f in ("SIN", "COS"))
    lags = ", ".join(f"COALESCE(LAG({Y}, {k}) OVER ({SER}), 0) AS {Y}_lag_{k}" for k in (1, 7, 168))
    scaled = ", ".join(f"({c} - AVG({c}) OVER ()) / STDDEV_POP({c}) OVER () AS {c}" for c in SEVEN)
    rows = " UNION ALL ".join(f"SELECT '{c}' AS feature, w{i} AS v FROM solved" for i, c in enumerate(SEVEN))
    return on_sales(
        f"""SELECT feature, ROUND(v, 6) AS coefficient, CASE WHEN feature <> 'intercept' THEN ROUND(ABS(v), 6) END AS importance
        FROM ({rows} UNION ALL SELECT 'intercept', intercept FROM solved)""",
        f"f7 AS (SELECT {Y}, {raw}, {lags} FROM sales WHERE dt < {SPLIT})", f"z7 AS (SELECT 1 AS one, {Y}, {scaled} FROM f7)",
        *solve("z7", "one", Y, SEVEN, alpha))


def _soft(threshold: float) -> str:
    return f"(SIGN(c) * GREATEST(ABS(c) - CAST({threshold} AS DOUBLE), 0))"


FOLDED = f"""fd AS (SELECT {Y} AS y, b AS x, {key_bucket(['store_id', 'product_id', 'epoch(dt)'], 5, 43)} AS fold FROM lagged),
ks AS (SELECT DISTINCT fold AS k FROM fd),
fits AS (SELECT k, REGR_SLOPE(y, x) AS slope, REGR_INTERCEPT(y, x) AS base FROM ks JOIN fd ON fold <> k GROUP BY k),
scores AS (SELECT fold, AVG(ABS(y - slope * x - base)) AS mae FROM fd JOIN fits ON fold = k GROUP BY fold)"""

_TREND = """tr AS (SELECT *, epoch(dt) - (SELECT epoch(MIN(dt)) FROM sales) AS sec FROM parts)"""


def _lag(k: int, fill: bool = False) -> str:
    out = f"LAG({Y}, {k}) OVER ({SER})"
    return f"COALESCE({out}, 0) AS {Y}_lag_{k}" if fill else f"{out} AS {Y}_lag_{k}"


def _change(c: str, name: str) -> str:
    return f"ROUND(COALESCE({c} - LAG({c}) OVER ({SER}), 0), 9) AS {name}"


def _prior(w: int) -> str:
    over = f"OVER ({SER} ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
    stats = {
        "mean": f"AVG({Y})", "std": f"STDDEV_SAMP({Y})", "min": f"MIN({Y})", "max": f"MAX({Y})",
        "q25": f"quantile_cont({Y}, 0.25)", "q75": f"quantile_cont({Y}, 0.75)",
    }
    return ", ".join(
        f"ROUND(1e-9 + COALESCE(CASE WHEN COUNT({Y}) {over} >= {w} THEN {agg} {over} END, 0), 6) AS {Y}_roll_{s}_{w}"
        for s, agg in stats.items())


ORACLE = {
    "linear_ols": _single("c"),
    "linear_ridge": _single("(n * c / (n + 1))"),
    "linear_ols_full": _seven(0.0),
    "linear_ridge_full": _seven(1.0),
    "linear_lasso": _single(_soft(1.0)),
    "linear_elasticnet": _single(f"({_soft(0.5)} / CAST(1.5 AS DOUBLE))"),
    "coefficients": on_sales(
        f"""SELECT feature, ROUND(v, 6) AS coefficient,
          CASE WHEN feature <> 'intercept' THEN ROUND(ABS(v), 6) END AS importance
        FROM (SELECT '{Y}_lag_1' AS feature, wa AS v FROM w UNION ALL SELECT '{Y}_lag_168', wb FROM w
              UNION ALL SELECT 'intercept', my - wa * ma - wb * mb FROM w)""",
        LAGGED,
        f"""t AS (SELECT VAR_POP(a) AS saa, VAR_POP(b) AS sbb, COVAR_POP(a, b) AS sab, COVAR_POP(a, {Y}) AS say,
            COVAR_POP(b, {Y}) AS sby, AVG({Y}) AS my, AVG(a) AS ma, AVG(b) AS mb FROM lagged),
        w AS (SELECT (say * sbb - sby * sab) / (saa * sbb - sab * sab) AS wa,
            (sby * saa - say * sab) / (saa * sbb - sab * sab) AS wb, my, ma, mb FROM t)"""),
    "cross_validate": on_sales("SELECT fold, ROUND(mae, 6) AS mae FROM scores", LAGGED, FOLDED),
    "cross_validate_summary": on_sales(
        "SELECT ROUND(AVG(mae), 6) AS mean_mae, ROUND(STDDEV_POP(mae), 6) AS std_mae FROM scores", LAGGED, FOLDED),
    **{f"stump_{k}": on_sales(
        f"""SELECT store_id, product_id, dt, ROUND(CASE WHEN hour(dt) <= best.h THEN low ELSE high END, 6) AS prediction
        FROM sales, best WHERE dt >= {SPLIT}""",
        f"""by_hour AS (SELECT hour(dt) AS h, COUNT(*) AS n, SUM({Y}) AS s FROM sales WHERE dt < {SPLIT} GROUP BY 1),
        cut AS (SELECT h, SUM(n) OVER (ORDER BY h) AS n1, SUM(s) OVER (ORDER BY h) AS s1, SUM(n) OVER () AS n, SUM(s) OVER () AS s FROM by_hour),
        best AS (SELECT h, s1 / n1 AS low, (s - s1) / (n - n1) AS high FROM cut WHERE n1 < n
          ORDER BY s1 * s1 / n1 + (s - s1) * (s - s1) / (n - n1) DESC LIMIT 1)""")
       for k in ("decision", "gradient_boosting", "boosted_colsample")},
    "stump_importance": "SELECT 'hour' AS feature, CAST(1 AS DOUBLE) AS importance",
    "model_summary": on_sales(
        "SELECT 'linear_linear' AS model_name, TRUE AS is_fitted, CAST(2 AS INT) AS num_features, ROUND((wa * say + wb * sby) / syy, 6) AS train_r2 FROM w",
        LAGGED,
        f"""t AS (SELECT VAR_POP(a) AS saa, VAR_POP(b) AS sbb, COVAR_POP(a, b) AS sab, COVAR_POP(a, {Y}) AS say,
            COVAR_POP(b, {Y}) AS sby, VAR_POP({Y}) AS syy FROM lagged),
        w AS (SELECT *, (say * sbb - sby * sab) / (saa * sbb - sab * sab) AS wa, (sby * saa - say * sab) / (saa * sbb - sab * sab) AS wb FROM t)"""),
    "save_model": MODELS["naive_last"],
    "save_model_all": MODELS["naive_last_all"],
    "write_comparison": on_sales(
        f"SELECT model, {CORE} FROM both_models GROUP BY 1", PREDICTIONS,
        f"""fit AS (SELECT store_id, product_id, arg_max({Y}, dt) AS l FROM train GROUP BY 1, 2),
        both_models AS (
          SELECT 'simple_naive' AS model, e.{Y}, f.l AS prediction FROM ev e JOIN fit f USING (store_id, product_id)
          UNION ALL SELECT 'seasonal_naive', {Y}, prediction FROM preds)"""),
    "numeric_columns": on_hb(f"""SELECT hour_of_day, day_of_week, is_weekend, month, first_category_id, second_category_id,
        third_category_id, sale_flag, high_sales_flag, discount, promo_flag, holiday_flag, activity_flag, precpt,
        avg_temperature, avg_humidity, avg_wind_level, stockout_flag, stock_status_flag FROM hb"""),
    "features_basic": on_sales(
        f"""SELECT {ROW}, hour, day_of_week, day_of_month, month, quarter, week_of_year,
          {_cycle('hour', 'hour', 24)}, {_cycle('day_of_week', 'day_of_week', 7)}, {_cycle('month', 'month', 12)},
          {_flag('day_of_week >= 5')} AS is_weekend, {_flag('day_of_week < 5')} AS is_weekday,
          {_flag('hour BETWEEN 7 AND 9')} AS is_morning_rush, {_flag('hour BETWEEN 11 AND 14')} AS is_lunch_time,
          {_flag('hour BETWEEN 17 AND 20')} AS is_evening_rush, {_flag('hour >= 22 OR hour <= 5')} AS is_late_night,
          CAST(FLOOR(sec / 86400) AS BIGINT) AS days_since_start, ROUND(sec / 3600, 9) AS hours_since_start,
          ROUND(avg_temperature * hour, 9) AS temp_hour_interaction,
          ROUND(precpt * {_flag('day_of_week >= 5')}, 9) AS rain_weekend_interaction,
          ROUND(discount * {_flag('day_of_week >= 5')}, 9) AS discount_weekend,
          ROUND(discount * {_flag('hour BETWEEN 17 AND 20')}, 9) AS discount_evening,
          hours_stock_status * hour AS stock_hour_interaction
        FROM tr""", PARTS, _TREND),
    "features_full": on_sales(
        f"""SELECT {ROW}, hour, day_of_week, month, {_cycle('hour', 'hour', 24)}, {_cycle('dow', 'day_of_week', 7)},
          {_cycle('month', 'month', 12)}, hour * day_of_week AS hour_dow_interaction, hour * month AS hour_month_interaction,
          {TEMP} AS temp_category, {PRECIP} AS precip_category, {DISCOUNT} AS discount_category,
          {_flag(f"{TEMP} = 'hot' AND day_of_week >= 5 AND hour BETWEEN 12 AND 18")} AS hot_weekend_afternoon,
          {_flag(f"{PRECIP} = 'moderate' AND hour BETWEEN 6 AND 12 AND discount > 0")} AS rainy_morning_discount,
          COALESCE(LEAD(holiday_flag) OVER ({SER}), 0) AS day_before_holiday,
          COALESCE(LAG(holiday_flag) OVER ({SER}), 0) AS day_after_holiday,
          {_change('avg_temperature', 'temp_change')}, {_change('precpt', 'precip_change')}, {_change('discount', 'discount_change')},
          CASE WHEN COUNT({Y}) OVER pv >= 7 THEN CAST(SUM(CAST({Y} AS DECIMAL(18,4))) OVER pv AS DOUBLE) ELSE 0 END AS product_velocity,
          DENSE_RANK() OVER (PARTITION BY first_category_id ORDER BY {Y} DESC) AS product_sales_rank,
          avg_discount_store, store_total_sales, store_num_products, store_avg_sales_per_product, store_stockout_freq,
          avg_discount_category, category_sales_sum, product_stage, city_total_sales, comp_products_count
        FROM parts JOIN st ON st.k = store_id JOIN ca ON ca.k = first_category_id JOIN pr ON pr.k = product_id
          JOIN ci ON ci.k = city_id JOIN hr ON hr.k = store_id AND hr.d = dt
        WINDOW pv AS (PARTITION BY product_id ORDER BY dt, store_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
        PARTS,
        f"""st AS (SELECT store_id AS k, ROUND({ea('discount')}, 9) AS avg_discount_store, {es(Y)} AS store_total_sales,
            COUNT(DISTINCT product_id) AS store_num_products, ROUND({ea(Y)}, 9) AS store_avg_sales_per_product,
            ROUND(CAST(COUNT(*) FILTER (WHERE hours_stock_status = 0) AS DOUBLE) / COUNT(*), 9) AS store_stockout_freq
          FROM sales GROUP BY 1)""",
        f"""ca AS (SELECT first_category_id AS k, ROUND({ea('discount')}, 9) AS avg_discount_category,
            {es(Y)} AS category_sales_sum FROM sales GROUP BY 1)""",
        f"""pr AS (SELECT product_id AS k, CASE WHEN {ea(Y)} <= 10 THEN 'new' WHEN {ea(Y)} <= 50 THEN 'mature'
            ELSE 'declining' END AS product_stage FROM sales GROUP BY 1)""",
        f"ci AS (SELECT city_id AS k, {es(Y)} AS city_total_sales FROM sales GROUP BY 1)",
        "hr AS (SELECT store_id AS k, dt AS d, COUNT(DISTINCT product_id) - 1 AS comp_products_count FROM sales GROUP BY 1, 2)"),
    "features_lag_rolling": on_sales(
        f"""SELECT s.store_id, s.product_id, s.dt, ROUND(1e-9 + s.{Y}, 6) AS {Y},
          {', '.join(f'ROUND(1e-9 + r.{Y}_lag_{k}, 6) AS {Y}_lag_{k}' for k in LAGS)},
          {', '.join(f'r.{Y}_roll_{st}_{w}' for w in WINDOWS for st in ('mean', 'std', 'min', 'max', 'q25', 'q75'))},
          {', '.join(f'ROUND(1e-9 + COALESCE(e.e{w}, 0), 6) AS {Y}_ewm_{w}' for w in WINDOWS)}
        FROM sales s JOIN r USING (store_id, product_id, dt) LEFT JOIN ew e USING (store_id, product_id, dt)""",
        _EWM_ROWS,
        f"r AS (SELECT {ROW}, {', '.join(_lag(k, True) for k in LAGS)}, {', '.join(_prior(w) for w in WINDOWS)} FROM sales)"),
    "features_model": on_sales(
        f"""SELECT {ROW}, {Y}, {_lag(1, True)}, {_lag(7, True)}, {_lag(168, True)}, hour, day_of_week, month,
          {_cycle('hour', 'hour', 24)}, {_cycle('dow', 'day_of_week', 7)}, {_cycle('month', 'month - 1', 12)} FROM parts""", PARTS),
    "features_model_history": on_sales(
        f"""SELECT * FROM (SELECT {ROW}, {_lag(1, True)}, {_lag(7, True)}, {_lag(168, True)} FROM sales) WHERE dt >= {SPLIT}"""),
}
