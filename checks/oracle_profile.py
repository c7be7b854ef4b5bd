"""Oracle SQL for sources, sampling and profiling."""

from __future__ import annotations

from .sqltext import SPLIT, ea, ea_when, es, on_sales

Y = "sale_amount"
ROW = "store_id, product_id, dt"
M, K = 2147483647, 48271


def key_bucket(keys: list[str], buckets: int, seed: int = 42) -> str:
    h = f"CAST({seed} AS BIGINT)"
    for k in keys:
        h = f"(({h} * {K} + ((CAST({k} AS BIGINT) % {M}) + {M}) % {M}) % {M})"
    return f"CAST(((({h} * {h}) % {M}) * {K} % {M}) % {buckets} AS INT)"


PREDICTIONS = f"""train AS (SELECT * FROM sales WHERE dt < {SPLIT}),
ev AS (SELECT * FROM sales WHERE dt >= {SPLIT}),
vol AS (SELECT product_id, {es(Y)} AS product_volume FROM train GROUP BY 1),
preds AS (
  SELECT e.*, COALESCE(t.{Y}, (SELECT quantile_cont({Y}, 0.5) FROM train)) AS prediction,
    CAST(hour(e.dt) AS INT) AS hour, vol.product_volume
  FROM ev e LEFT JOIN train t ON t.store_id = e.store_id AND t.product_id = e.product_id
    AND t.dt = e.dt - INTERVAL 168 HOUR
  LEFT JOIN vol ON vol.product_id = e.product_id)"""

_NUMERIC = [
    ("city_id", "bigint"), ("store_id", "bigint"), ("product_id", "bigint"), ("first_category_id", "bigint"),
    ("second_category_id", "bigint"), ("third_category_id", "bigint"), (Y, "double"), ("hours_stock_status", "int"),
    ("discount", "double"), ("holiday_flag", "int"), ("activity_flag", "int"), ("precpt", "double"),
    ("avg_temperature", "double"), ("avg_humidity", "double"), ("avg_wind_level", "double"),
]
_DESCRIBE = "\nUNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{t}' AS dtype, COUNT({c}) AS "count", ROUND(AVG({c}), 6) AS mean,
      ROUND(STDDEV_SAMP({c}), 6) AS std, CAST(MIN({c}) AS DOUBLE) AS min,
      CAST(quantile_cont(CAST({c} AS DOUBLE), 0.25) AS DOUBLE) AS q25,
      CAST(quantile_cont(CAST({c} AS DOUBLE), 0.5) AS DOUBLE) AS q50,
      CAST(quantile_cont(CAST({c} AS DOUBLE), 0.75) AS DOUBLE) AS q75, CAST(MAX({c}) AS DOUBLE) AS max FROM sales"""
    for c, t in _NUMERIC
)
_DOC_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]
_DOCS = "(SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))"
_NULLS = "\nUNION ALL ".join(
    f"""SELECT '{c}' AS "column", COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE {c} IS NULL) AS nulls FROM docs"""
    for c in _DOC_COLUMNS
)

ORACLE = {
    "scan_sales": on_sales("SELECT * FROM sales"),
    "parse_dt": "SELECT event_id, CAST(ts AS TIMESTAMP) AS dt FROM events",
    "sample_fraction": on_sales(
        f"SELECT {ROW} FROM sales WHERE {key_bucket(['store_id', 'product_id'], 1000)} < 300"),
    "sample_n": on_sales(f"""SELECT {ROW}, {Y} FROM sales
        ORDER BY {key_bucket(['store_id', 'product_id', 'epoch(dt)'], M)}, {ROW} LIMIT 100"""),
    "sort_series": on_sales(f"SELECT {ROW}, {Y} FROM sales"),
    "preview": on_sales(f"SELECT * FROM sales ORDER BY {ROW} LIMIT 5"),
    "write_predictions": on_sales(f"SELECT {ROW}, prediction FROM preds", PREDICTIONS),
    "profile_shape": on_sales(f"""
        SELECT CASE WHEN dt < {SPLIT} THEN 'train' ELSE 'eval' END AS dataset, COUNT(*) AS n_rows,
          CAST(16 AS INT) AS n_columns FROM sales GROUP BY 1"""),
    "profile_time_span": on_sales("""
        SELECT MIN(dt) AS start, MAX(dt) AS "end",
          CAST(FLOOR((epoch(MAX(dt)) - epoch(MIN(dt))) / 86400) AS BIGINT) AS duration_days FROM sales"""),
    "profile_dimensions": on_sales("""
        SELECT COUNT(DISTINCT store_id) AS unique_stores, COUNT(DISTINCT product_id) AS unique_products,
          COUNT(DISTINCT city_id) AS unique_cities,
          COUNT(DISTINCT (store_id, product_id)) AS total_store_product_combinations FROM sales"""),
    "profile_target": on_sales(f"""
        SELECT {ea(Y)} AS mean_sales, quantile_cont({Y}, 0.5) AS median_sales,
          CAST(COUNT(*) FILTER (WHERE {Y} = 0) AS DOUBLE) / COUNT(*) * 100 AS zero_sales_percentage,
          MAX({Y}) AS max_sales FROM sales"""),
    "profile_stockout": on_sales("""
        SELECT COUNT(*) AS total_observations, COUNT(*) FILTER (WHERE hours_stock_status = 0) AS stockout_hours,
          CAST(COUNT(*) FILTER (WHERE hours_stock_status = 0) AS DOUBLE) / COUNT(*) * 100 AS stockout_rate_percent,
          COUNT(DISTINCT CASE WHEN hours_stock_status = 0 THEN store_id END) AS stores_with_stockouts FROM sales"""),
    "profile_nulls": f'WITH docs AS {_DOCS} SELECT "column", nulls AS missing FROM ({_NULLS})',
    "profile_duplicates": """
        SELECT CAST(SUM(n - 1) AS BIGINT) AS duplicate_rows
        FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
          l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)""",
    "describe": on_sales(_DESCRIBE),
    "target_moments": on_sales(
        f"""SELECT ROUND(mean, 6) AS mean, ROUND(median, 6) AS median, ROUND(std, 6) AS std,
          ROUND((s3/n - 3*m*s2/n + 3*m*m*s1/n - m*m*m) / POWER(s2/n - m*m, 1.5), 6) AS skewness
        FROM (SELECT {ea(Y)} AS mean, quantile_cont({Y}, 0.5) AS median, STDDEV_SAMP({Y}) AS std, AVG({Y}) AS m,
                COUNT(*) AS n, SUM({Y}) AS s1, SUM({Y}*{Y}) AS s2, SUM({Y}*{Y}*{Y}) AS s3 FROM sales)"""),
    "zero_ratio": on_sales(
        f"SELECT CAST(COUNT(*) FILTER (WHERE {Y} = 0) AS DOUBLE) / COUNT(*) AS zero_ratio FROM sales"),
    "sales_histogram": on_sales(
        f"""SELECT CAST(bin AS INT) AS bin, ROUND(lo + w * bin / 50, 6) AS bin_start,
          ROUND(lo + w * (bin + 1) / 50, 6) AS bin_end, COUNT(*) AS n
        FROM (SELECT lo, hi - lo AS w, LEAST(FLOOR(({Y} - lo) / (hi - lo) * 50), 49) AS bin FROM sales, ends)
        GROUP BY bin, lo, w""",
        f"ends AS (SELECT MIN({Y}) AS lo, MAX({Y}) AS hi FROM sales)"),
    "mean_by_hour": on_sales(f"SELECT CAST(hour(dt) AS INT) AS hour, {ea(Y)} AS avg_sales FROM sales GROUP BY 1"),
    "mean_by_dow": on_sales(
        f"SELECT CAST(isodow(dt) - 1 AS INT) AS day_of_week, {ea(Y)} AS avg_sales FROM sales GROUP BY 1"),
    "hour_dow_pivot": on_sales(
        "SELECT CAST(hour(dt) AS INT) AS hour, "
        + ", ".join(f"{ea_when(f'isodow(dt) - 1 = {d}', Y)} AS dow_{d}" for d in range(7))
        + " FROM sales GROUP BY 1"),
    "stockout_profile": on_sales(f"""
        SELECT CAST(COUNT(*) FILTER (WHERE hours_stock_status = 0) AS DOUBLE) / COUNT(*) AS stockout_rate,
          {ea_when('hours_stock_status <> 0', Y)} AS avg_sales_in_stock,
          {ea_when('hours_stock_status = 0', Y)} AS avg_sales_out_of_stock FROM sales"""),
    "stockout_by_hour": on_sales("""
        SELECT CAST(hour(dt) AS INT) AS hour,
          CAST(COUNT(*) FILTER (WHERE hours_stock_status = 0) AS DOUBLE) / COUNT(*) AS stockout_rate
        FROM sales GROUP BY 1"""),
    "top_stores": on_sales(
        f"SELECT store_id, {es(Y)} AS total_sales FROM sales GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"),
    "outlier_flag": on_sales(
        f"""SELECT {ROW}, ROUND(({Y} - m) / sd, 6) AS sale_zscore, ABS(({Y} - m) / sd) > 3.0 AS outlier_flag
        FROM sales, stats""",
        f"stats AS (SELECT {ea(Y)} AS m, STDDEV_SAMP({Y}) AS sd FROM sales)"),
    "validate_input": f"""WITH docs AS {_DOCS} SELECT "column", n_rows, nulls, CAST(nulls AS DOUBLE) / n_rows AS null_share,
        CASE WHEN n_rows = 0 THEN 'empty' WHEN "column" = 'quality' AND nulls > 0 THEN 'null target'
          WHEN CAST(nulls AS DOUBLE) / n_rows > 0.5 THEN 'mostly null' ELSE 'ok' END AS issue
        FROM ({_NULLS})""",
}
