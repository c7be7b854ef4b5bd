"""Oracle SQL for horizons, hierarchies, trends, substitutes and residuals."""

from __future__ import annotations

from math import ceil

from .oracle_profile import PREDICTIONS
from .sqltext import SER, SPLIT, ea_when, es, on_sales, solve

Y = "sale_amount"
ROW = "store_id, product_id, dt"
HORIZONS = (1, 6, 24, 168)
KNOWN = ("last", "day", "week", "mean_day", "mean_week")


def _lag(k: int, x: str = Y) -> str:
    return f"LAG({x}, {k}) OVER ({SER})"


def _mean(w: int) -> str:
    over = f"OVER ({SER} ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN ROW_NUMBER() OVER ({SER}) >= {w} THEN AVG({Y}) {over} END"


_MEANS = f"hm AS (SELECT {ROW}, {Y}, {_mean(24)} AS md, {_mean(168)} AS mw FROM sales)"
_ORIGINS = "o AS (" + " UNION ALL ".join(
    f"""SELECT {ROW}, {Y}, CAST({h} AS INT) AS horizon, {_lag(h, 'dt')} AS origin, {_lag(h)} AS last, {_lag(24 * ceil(h / 24))} AS day,
    {_lag(168 * ceil(h / 168))} AS week, {_lag(h, 'md')} AS mean_day, {_lag(h, 'mw')} AS mean_week,
    {_lag(h)} + {h} * ({_lag(h)} - {_lag(h + 168)}) / 168 AS drift FROM hm""" for h in HORIZONS) + ")"
_PAST = f"past AS (SELECT * FROM o WHERE origin IS NOT NULL AND dt < {SPLIT})"
_WEIGHTS = solve("past", "horizon", Y, KNOWN, alpha=1.0)
_FORECASTS = f"""future AS (SELECT o.*, intercept + {' + '.join(f'w{i} * {c}' for i, c in enumerate(KNOWN))} AS direct
  FROM o JOIN solved s USING (horizon) WHERE origin IS NOT NULL AND dt >= {SPLIT})""", "f AS (" + " UNION ALL ".join(
    f"SELECT '{m}' AS model, horizon, {Y} AS y, {m} AS p FROM future WHERE {m} IS NOT NULL" for m in (*KNOWN, "drift", "direct")) + ")"

_KEYS = "store_id, first_category_id, product_id"
_OWN = "GREATEST(2 * {0}last - {0}before, 0)"


def _part(whole: str, to: str, size: str, of: str) -> str:
    down = lambda at: f"COALESCE(CAST({whole} AS HUGEINT) * ({at}) // NULLIF({of}, 0), 0)"
    return f"{down(to)} - {down(f'{to} - {size}')}"


_HIERARCHY = (
    f"""wk AS (SELECT {_KEYS}, CAST(ROUND({Y} * 10000) AS BIGINT) AS u, CAST(date_diff('hour', {SPLIT}, dt) AS BIGINT) AS hh FROM sales
      WHERE dt >= {SPLIT} - INTERVAL 336 HOUR AND dt < {SPLIT} + INTERVAL 168 HOUR)""",
    f"""ws AS (SELECT {_KEYS}, {SPLIT} + to_hours(((hh % 168) + 168) % 168) AS dt, SUM(CASE WHEN hh >= 0 THEN u ELSE 0 END) AS actual,
      SUM(CASE WHEN hh BETWEEN -168 AND -1 THEN u ELSE 0 END) AS last, SUM(CASE WHEN hh < -168 THEN u ELSE 0 END) AS before FROM wk GROUP BY ALL)""",
    f"tt AS (SELECT dt, {_OWN.format('').replace('last', 'SUM(last)').replace('before', 'SUM(before)')} AS total FROM ws GROUP BY dt)",
    "sz AS (SELECT store_id, product_id, SUM(last + before) AS size FROM ws GROUP BY 1, 2)",
    "sp AS (SELECT *, SUM(size) OVER (PARTITION BY store_id ORDER BY product_id) AS upto, SUM(size) OVER (PARTITION BY store_id) AS of FROM sz)",
    "st AS (SELECT store_id, ANY_VALUE(of) AS store FROM sp GROUP BY 1)",
    "su AS (SELECT *, SUM(store) OVER (ORDER BY store_id) AS store_to, SUM(store) OVER () AS every FROM st)",
    f"""da AS (SELECT ws.*, size, upto, of, {_OWN.format('')} AS bottom_up, {_part('total', 'store_to', 'store', 'every')} AS of_store
      FROM ws JOIN tt USING (dt) JOIN sp USING (store_id, product_id) JOIN su USING (store_id))""",
    f"db AS (SELECT *, {_part('of_store', 'upto', 'size', 'of')} AS top_down FROM da)",
    f"""hi AS (SELECT CASE GROUPING(store_id) * 4 + GROUPING(first_category_id) * 2 + GROUPING(product_id) WHEN 7 THEN 'total' WHEN 3 THEN 'store'
      WHEN 5 THEN 'category' WHEN 4 THEN 'product' WHEN 1 THEN 'store_category' ELSE 'store_product' END AS level, {_KEYS}, dt,
      SUM(actual) AS actual, {_OWN.format('').replace('last', 'SUM(last)').replace('before', 'SUM(before)')} AS base, SUM(bottom_up) AS bottom_up,
      SUM(top_down) AS top_down FROM db GROUP BY GROUPING SETS ((dt), (dt, store_id), (dt, first_category_id), (dt, first_category_id, product_id),
        (dt, store_id, first_category_id), (dt, {_KEYS})))""",
)
_METHODS = ("base", "bottom_up", "top_down")

_PAIRS = (
    "nc AS (SELECT first_category_id AS c, COUNT(DISTINCT (store_id, dt)) AS cells FROM sales GROUP BY 1)",
    f"sm AS (SELECT product_id AS p, SUM({Y}) AS s, SUM({Y} * {Y}) AS ss FROM sales GROUP BY 1)",
    f"""pr AS (SELECT a.first_category_id AS c, a.product_id AS pa, b.product_id AS pb, COUNT(*) AS support, SUM(a.{Y} * b.{Y}) AS xy
      FROM sales a JOIN sales b ON a.store_id = b.store_id AND a.dt = b.dt AND a.first_category_id = b.first_category_id AND a.product_id < b.product_id
      WHERE a.{Y} <> 0 AND b.{Y} <> 0 GROUP BY 1, 2, 3)""",
    """co AS (SELECT pr.c, pa, pb, support, ROUND((cells * xy - x.s * y.s)
      / NULLIF(SQRT((cells * x.ss - x.s * x.s) * (cells * y.ss - y.s * y.s)), 0), 9) AS r
      FROM pr JOIN nc ON nc.c = pr.c JOIN sm x ON x.p = pa JOIN sm y ON y.p = pb)""",
)
_BEST = (
    """be AS (SELECT p, arg_min(q, (r, q)) AS q, MIN(r) AS r FROM (SELECT pa AS p, pb AS q, r FROM co UNION ALL SELECT pb, pa, r FROM co)
      WHERE r IS NOT NULL GROUP BY p)""",
    f"""cj AS (SELECT a.product_id AS p, a.{Y} AS y, a.discount AS own, b.discount AS other FROM sales a JOIN be ON be.p = a.product_id
      JOIN sales b ON b.store_id = a.store_id AND b.dt = a.dt AND b.product_id = be.q)""",
)
_BREAKS = (
    "hd AS (SELECT DISTINCT city_id, date_trunc('day', dt) AS day FROM sales WHERE holiday_flag = 1)",
    """br AS (SELECT city_id, day - to_days(CAST(city_id AS INT)) AS a, day + to_days(CAST(2 + city_id AS INT)) AS b FROM hd
      UNION ALL SELECT city_id, day - INTERVAL 1 DAY, day + INTERVAL 1 DAY FROM hd)""",
    """bn AS (SELECT *, SUM(fresh) OVER (PARTITION BY city_id ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS k FROM (SELECT *, CASE WHEN
      a <= MAX(b) OVER (PARTITION BY city_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM br))""",
    "bm AS (SELECT city_id, k, MIN(a) AS a, MAX(b) AS b FROM bn GROUP BY 1, 2)",
    "sb AS (SELECT s.*, bm.a, bm.b FROM sales s LEFT JOIN bm ON bm.city_id = s.city_id AND s.dt BETWEEN bm.a AND bm.b)",
)
_CUSUM = (
    PREDICTIONS,
    f"""rs AS (SELECT {ROW}, {Y} - prediction AS r, CAST({Y} - prediction AS DECIMAL(18,4)) AS d, ROW_NUMBER() OVER ({SER}) AS rn FROM preds)""",
    """sd AS (SELECT store_id, product_id, CAST(ROUND(STDDEV_POP(r) * 0.5, 4) AS DECIMAL(18,4)) AS k, CAST(ROUND(STDDEV_POP(r) * 5.0, 4) AS DECIMAL(18,4)) AS lim,
      AVG(r) AS m, VAR_POP(r) AS v, COUNT(*) AS n FROM rs GROUP BY 1, 2)""",
    """cu AS (SELECT store_id, product_id, dt, rn, CAST(GREATEST(d - k, 0) AS DECIMAL(28,4)) AS up, CAST(GREATEST(-d - k, 0) AS DECIMAL(28,4)) AS down
        FROM rs JOIN sd USING (store_id, product_id) WHERE rn = 1
      UNION ALL SELECT rs.store_id, rs.product_id, rs.dt, rs.rn, CAST(GREATEST(cu.up + d - k, 0) AS DECIMAL(28,4)), CAST(GREATEST(cu.down - d - k, 0) AS DECIMAL(28,4))
        FROM cu JOIN rs ON rs.store_id = cu.store_id AND rs.product_id = cu.product_id AND rs.rn = cu.rn + 1
        JOIN sd ON sd.store_id = rs.store_id AND sd.product_id = rs.product_id)""",
    f"""al AS (SELECT {ROW}, up, down, lim, CASE WHEN lim > 0 AND up > lim AND COALESCE(LAG(up) OVER ({SER}), 0) <= lim THEN 1
        WHEN lim > 0 AND down > lim AND COALESCE(LAG(down) OVER ({SER}), 0) <= lim THEN -1 ELSE 0 END AS alarm FROM cu JOIN sd USING (store_id, product_id))""",
    f"lg AS (SELECT *, LAG(r, 1) OVER ({SER}) AS l1, LAG(r, 24) OVER ({SER}) AS l24 FROM rs)",
)

ORACLE = {
    "store_profiles": on_sales(
        """SELECT store_id, total, CAST(slot AS INT) AS slot, ROUND(COALESCE(s / NULLIF(total, 0), 0), 9) AS share FROM
          (SELECT store_id, total, unnest(generate_series(0, 167)) AS slot FROM tot) LEFT JOIN so USING (store_id, slot)""",
        f"so AS (SELECT store_id, (isodow(dt) - 1) * 24 + hour(dt) AS slot, {es(Y)} AS s FROM sales GROUP BY 1, 2)",
        f"tot AS (SELECT store_id, {es(Y)} AS total FROM sales GROUP BY 1)"),
    "substitutability": on_sales("SELECT c AS first_category_id, pa AS product_a, pb AS product_b, support, r AS correlation FROM co WHERE support >= 2", *_PAIRS),
    "cannibalization": on_sales(
        """SELECT s.p AS product_id, be.q AS substitute_id, ROUND(be.r, 6) AS correlation, n, ROUND(w0, 6) AS own_effect, ROUND(w1, 6) AS cross_effect,
          ROUND(intercept, 6) AS intercept, ROUND(r2, 6) AS r2, w1 < 0 AS cannibalized FROM solved s JOIN be ON be.p = s.p""",
        *_PAIRS, *_BEST, *solve("cj", "p", "y", ("own", "other"))),
    "school_calendar": on_sales(
        f"""SELECT {ROW}, CAST(a IS NOT NULL AS INT) AS school_break, CAST(epoch(dt) - epoch(a) AS DOUBLE) / 3600 AS school_hours_since,
          CAST(epoch(b) - epoch(dt) AS DOUBLE) / 3600 AS school_hours_left FROM sb""", *_BREAKS),
    "school_effect": on_sales(
        f"""SELECT city_id, n_break, ROUND(mb, 9) AS mean_break, ROUND(mr, 9) AS mean_rest, ROUND(mb - mr, 9) AS effect FROM (
          SELECT city_id, COUNT(a) AS n_break, {ea_when('a IS NOT NULL', Y)} AS mb, {ea_when('a IS NULL', Y)} AS mr FROM sb GROUP BY 1)""", *_BREAKS),
    "cumulative_bias": on_sales(
        f"""SELECT {ROW}, ROUND(CAST(up AS DOUBLE), 6) AS cusum_up, ROUND(CAST(down AS DOUBLE), 6) AS cusum_down, ROUND(CAST(lim AS DOUBLE), 6) AS cusum_limit,
          CAST(alarm AS INT) AS cusum_alarm FROM al""", *_CUSUM),
    "residual_bias": on_sales(
        """SELECT sd.store_id, sd.product_id, n, ROUND(m, 6) AS bias, ROUND(p1 / NULLIF(n * v, 0), 6) AS acf_1, ROUND(p24 / NULLIF(n * v, 0), 6) AS acf_24,
          ROUND(max_up, 6) AS max_up, ROUND(max_down, 6) AS max_down, n_alarms, first_alarm
        FROM sd JOIN (SELECT store_id, product_id, CAST(MAX(up) AS DOUBLE) AS max_up, CAST(MAX(down) AS DOUBLE) AS max_down, COUNT(*) FILTER (alarm <> 0) AS n_alarms,
            MIN(CASE WHEN alarm <> 0 THEN dt END) AS first_alarm FROM al GROUP BY 1, 2) USING (store_id, product_id)
          JOIN (SELECT lg.store_id, lg.product_id, SUM((r - m) * (l1 - m)) AS p1, SUM((r - m) * (l24 - m)) AS p24 FROM lg JOIN sd USING (store_id, product_id)
            GROUP BY 1, 2) USING (store_id, product_id)""", *_CUSUM),
    "hierarchy_forecast": on_sales(
        f"SELECT level, {_KEYS}, dt, " + ", ".join(f"CAST({c} AS DOUBLE) / 10000 AS {c}" for c in ("actual", *_METHODS)) + " FROM hi", *_HIERARCHY),
    "hierarchy_metrics": on_sales(
        "SELECT level, method, COUNT(*) AS n, ROUND(CAST(SUM(miss) AS DOUBLE) / COUNT(*) / 10000, 9) AS mae, "
        "ROUND(CAST(SUM(miss) AS DOUBLE) / NULLIF(SUM(actual), 0), 9) AS wape FROM ms GROUP BY 1, 2",
        *_HIERARCHY, "ms AS (" + " UNION ALL ".join(f"SELECT level, '{m}' AS method, actual, ABS(actual - {m}) AS miss FROM hi" for m in _METHODS) + ")"),
    "horizon_metrics": on_sales(
        """SELECT model, horizon, COUNT(*) AS n, ROUND(AVG(ABS(y - p)), 6) AS mae, ROUND(SQRT(AVG((y - p) * (y - p))), 6) AS rmse,
          ROUND(AVG(p - y), 6) AS bias FROM f GROUP BY 1, 2""", _MEANS, _ORIGINS, _PAST, *_WEIGHTS, *_FORECASTS),
    "horizon_weights": on_sales(
        "SELECT horizon, n, " + ", ".join(f"ROUND(w{i}, 6) AS w{i}" for i in range(len(KNOWN)))
        + ", ROUND(intercept, 6) AS intercept, ROUND(r2, 6) AS r2 FROM solved", _MEANS, _ORIGINS, _PAST, *_WEIGHTS),
}
