"""Pieces shared by the oracle SQL texts."""

from __future__ import annotations

RETAIL_CTES = """
cell AS (
  SELECT CAST(FLOOR(user_id/15.0) AS BIGINT) AS store_id,
         CAST(json_extract_string(props,'$.k') AS BIGINT) % 12 AS product_id,
         CAST(date_trunc('hour', ts) AS TIMESTAMP) AS dt,
         SUM(CASE WHEN event_type <> 'error' THEN CAST(ROUND(value*100) AS BIGINT) ELSE 0 END) AS cents,
         MAX(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS err
  FROM events GROUP BY 1, 2, 3),
s AS (SELECT DISTINCT store_id FROM cell),
p AS (SELECT DISTINCT product_id FROM cell),
h AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 23:00:00', INTERVAL 1 HOUR)) AS dt),
g AS (SELECT s.store_id, p.product_id, h.dt, CAST(day(h.dt) AS BIGINT) AS d, CAST(hour(h.dt) AS BIGINT) AS hr,
        CAST(isodow(h.dt) AS BIGINT) - 1 AS wd, c.cents, c.err
  FROM s CROSS JOIN p CROSS JOIN h
  LEFT JOIN cell c ON c.store_id = s.store_id AND c.product_id = p.product_id AND c.dt = h.dt),
sales AS (
  SELECT store_id % 3 AS city_id, store_id, product_id,
    product_id % 3 AS first_category_id, product_id % 6 AS second_category_id, product_id % 12 AS third_category_id,
    dt,
    CAST(COALESCE(cents,0) * 2 * (product_id+1)
      * (CASE wd WHEN 0 THEN 5 WHEN 1 THEN 20 WHEN 2 THEN 50 ELSE 100 END) AS DOUBLE) / 10000 AS sale_amount,
    CAST(CASE WHEN err = 1 THEN 0 ELSE 1 END AS INT) AS hours_stock_status,
    CAST((product_id*7 + d) % 8 * 4 AS DOUBLE) / 100 AS discount,
    CAST(CASE WHEN d IN (1,15) THEN 1 ELSE 0 END AS INT) AS holiday_flag,
    CAST(CASE WHEN (product_id + d) % 3 = 0 THEN 1 ELSE 0 END AS INT) AS activity_flag,
    CAST((d % 5) * 3 AS DOUBLE) / 2 AS precpt,
    CAST((d*7) % 32 AS DOUBLE) + CAST(hr AS DOUBLE)/4 AS avg_temperature,
    CAST(40 + (d % 7)*5 AS DOUBLE) AS avg_humidity,
    CAST(1 + hr % 5 AS DOUBLE)/2 AS avg_wind_level
  FROM g)"""

HB_CTE = """,
hb AS (
  SELECT dt, CAST(hour(dt) AS INT) AS hour_of_day, CAST(dayofweek(dt) AS INT) AS day_of_week,
    CAST(CASE WHEN dayofweek(dt) IN (0,6) THEN 1 ELSE 0 END AS INT) AS is_weekend,
    CAST(month(dt) AS INT) AS month,
    city_id, store_id, first_category_id, second_category_id, third_category_id, product_id, sale_amount,
    CAST(CASE WHEN sale_amount > 0 THEN 1 ELSE 0 END AS INT) AS sale_flag,
    CAST(CASE WHEN sale_amount > 10 THEN 1 ELSE 0 END AS INT) AS high_sales_flag,
    discount, CAST(CASE WHEN discount > 0 THEN 1 ELSE 0 END AS INT) AS promo_flag,
    holiday_flag, activity_flag,
    CASE WHEN precpt > 0 THEN 'rainy' ELSE 'clear' END AS weather,
    precpt, avg_temperature, avg_humidity, avg_wind_level,
    CAST(CASE WHEN sale_amount = 0 AND activity_flag = 1 THEN 1 ELSE 0 END AS INT) AS stockout_flag,
    CAST(CASE WHEN hours_stock_status = 0 THEN 1 ELSE 0 END AS INT) AS stock_status_flag
  FROM sales)"""

SPLIT = "TIMESTAMP '2024-01-24'"
SER = "PARTITION BY store_id, product_id ORDER BY dt"


def on_sales(body: str, *ctes: str) -> str:
    return "WITH RECURSIVE " + RETAIL_CTES + "".join(", " + c for c in ctes) + "\n" + body


def on_hb(body: str, *ctes: str) -> str:
    return "WITH RECURSIVE " + RETAIL_CTES + HB_CTE + "".join(", " + c for c in ctes) + "\n" + body


def es(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,4))) AS DOUBLE)"


def ea(x: str) -> str:
    return f"({es(x)} / NULLIF(COUNT({x}), 0))"


def ea_when(cond: str, x: str) -> str:
    return ea(f"CASE WHEN {cond} THEN {x} END")


def es_when(cond: str, x: str) -> str:
    return es(f"CASE WHEN {cond} THEN {x} ELSE 0 END")


def n_when(cond: str) -> str:
    return f"CAST(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


def isum(x: str) -> str:
    return f"CAST(SUM({x}) AS BIGINT)"


def pct(x: str = "stockout_flag") -> str:
    return f"CAST(100 AS DOUBLE) * SUM({x}) / COUNT(*)"


def share(x: str) -> str:
    return f"CAST(SUM({x}) AS DOUBLE) / NULLIF(COUNT({x}), 0)"


def solve(table: str, key: str, y: str, xs: tuple[str, ...], alpha: float = 0.0) -> list[str]:
    """CTEs that end in ``solved`` (key, n, w0.., intercept, r2): normal equations per group, by Cholesky factors."""
    k = len(xs)
    known = " AND ".join(f"{x} IS NOT NULL" for x in (y, *xs))
    aggs = [f"AVG({x}) AS m{i}, COVAR_POP({x}, {y}) AS b{i}" for i, x in enumerate(xs)]
    aggs += [f"COVAR_POP({xs[i]}, {xs[j]}) + {alpha if i == j else 0}::DOUBLE / COUNT(*) AS a{i}_{j}" for i in range(k) for j in range(i + 1)]
    out = [f"mo AS (SELECT {key}, COUNT(*) AS n, AVG({y}) AS my, VAR_POP({y}) AS vy, {', '.join(aggs)} FROM {table} WHERE {known} GROUP BY {key})"]
    last = "mo"
    for j in range(k):
        below = [f"(a{i}_{j}{''.join(f' - l{i}_{q} * l{j}_{q}' for q in range(j))}) / l{j}_{j} AS l{i}_{j}" for i in range(j + 1, k)]
        pivot = f"SQRT(a{j}_{j}{''.join(f' - l{j}_{q} * l{j}_{q}' for q in range(j))}) AS l{j}_{j}"
        forward = f"(b{j}{''.join(f' - l{j}_{q} * z{q}' for q in range(j))}) / l{j}_{j} AS z{j}"
        out += [f"p{j} AS (SELECT *, {pivot} FROM {last})", f"e{j} AS (SELECT *, {', '.join([*below, forward])} FROM p{j})"]
        last = f"e{j}"
    for j in reversed(range(k)):
        back = f"(z{j}{''.join(f' - l{q}_{j} * w{q}' for q in range(j + 1, k))}) / l{j}_{j} AS w{j}"
        out.append(f"back{j} AS (SELECT *, {back} FROM {last})")
        last = f"back{j}"
    base = "my" + "".join(f" - w{i} * m{i}" for i in range(k))
    out.append(f"solved AS (SELECT {key}, n, {', '.join(f'w{i}' for i in range(k))}, {base} AS intercept, "
               f"({' + '.join(f'w{i} * b{i}' for i in range(k))}) / vy AS r2 FROM {last})")
    return out
