"""Oracle SQL for input preparation, naive forecasters and metrics."""

from __future__ import annotations

from .oracle_profile import PREDICTIONS, key_bucket
from .sqltext import SER, SPLIT, ea, on_sales

Y = "sale_amount"
P = "prediction"
ROW = "store_id, product_id, dt"
FEATURES = ["avg_temperature", f"{Y}_lag_1", f"{Y}_lag_168"]
WINDOWS = (6, 24, 168)

FEATURE_ROWS = f"""fr AS (SELECT {ROW}, avg_temperature, LAG({Y}, 1) OVER ({SER}) AS {Y}_lag_1,
  LAG({Y}, 168) OVER ({SER}) AS {Y}_lag_168 FROM sales),
ft AS (SELECT * FROM fr WHERE dt < {SPLIT})"""


def _each(fmt: str, cols=FEATURES) -> str:
    return ", ".join(f"ROUND({fmt.format(c=c)}, 6) AS {c}" for c in cols)


def _sub(expr: str) -> str:
    return f"(SELECT {expr} FROM ft)"


SEEN = f"""seen AS (SELECT {ROW}, {Y}, ROW_NUMBER() OVER ({SER}) - 1 AS pos,
    ROW_NUMBER() OVER (PARTITION BY store_id, product_id ORDER BY dt DESC) AS back
  FROM sales WHERE dt < {SPLIT} AND NOT (store_id = 0 AND product_id = 11)),
ev AS (SELECT {ROW} FROM sales WHERE dt >= {SPLIT})"""
MED = f"(SELECT quantile_cont({Y}, 0.5) FROM seen)"


def _naive(value: str, default: str = "0", on: str = "", group: str = "", where: str = "TRUE") -> str:
    fitted = f"fit AS (SELECT store_id, product_id{group}, {value} AS v FROM seen WHERE {where} GROUP BY ALL)"
    return on_sales(
        f"""SELECT e.store_id, e.product_id, e.dt, ROUND(COALESCE(f.v, {default}), 6) AS prediction
        FROM ev e LEFT JOIN fit f ON f.store_id = e.store_id AND f.product_id = e.product_id {on}""", SEEN, fitted)


def _last(x: str = Y) -> str:
    return f"MAX(CASE WHEN back = 1 THEN {x} END)"


def _moving() -> str:
    means = []
    for w in WINDOWS:
        weight = f"EXP(-1 + COALESCE((w_pos_{w} - 1) / NULLIF(CAST(n_{w} AS DOUBLE) - 1, 0), 0))"
        means.append(f"SUM(CASE WHEN in_{w} THEN {Y} * {weight} END) / SUM(CASE WHEN in_{w} THEN {weight} END) AS m_{w}")
    inside = ", ".join(f"dt > last_dt - INTERVAL {w} HOUR AS in_{w}" for w in WINDOWS)
    placed = ", ".join(
        f"ROW_NUMBER() OVER (PARTITION BY store_id, product_id, in_{w} ORDER BY dt) AS w_pos_{w}, "
        f"COUNT(*) OVER (PARTITION BY store_id, product_id, in_{w}) AS n_{w}" for w in WINDOWS)
    ctes = [
        SEEN,
        f"a AS (SELECT *, MAX(dt) OVER (PARTITION BY store_id, product_id) AS last_dt FROM seen)",
        f"b AS (SELECT *, {inside} FROM a)",
        f"c AS (SELECT *, {placed} FROM b)",
        f"d AS (SELECT store_id, product_id, {', '.join(means)} FROM c GROUP BY 1, 2)",
        f"""fit AS (SELECT store_id, product_id,
          ({' + '.join(f'm_{w} * (CAST(1 AS DOUBLE) / {w})' for w in WINDOWS)})
            / ({' + '.join(f'CAST(1 AS DOUBLE) / {w}' for w in WINDOWS)}) AS v FROM d)""",
    ]
    return on_sales(
        f"""SELECT e.store_id, e.product_id, e.dt, ROUND(COALESCE(f.v, {MED}), 6) AS prediction
        FROM ev e LEFT JOIN fit f USING (store_id, product_id)""", *ctes)


ERR = f"({Y} - {P})"
MAE = f"AVG(ABS({ERR}))"
RMSE = f"SQRT(AVG({ERR} * {ERR}))"
MAPE_C = f"AVG(ABS({ERR} / GREATEST(ABS({Y}), 1e-8))) * 100"
MAPE_N = f"AVG(CASE WHEN {Y} <> 0 THEN ABS({ERR} / {Y}) END) * 100"
SMAPE = f"AVG(ABS({ERR}) / ((ABS({Y}) + ABS({P})) / 2 + 1e-8)) * 100"
BIAS = f"AVG({P} - {Y})"
BIAS_PCT = f"AVG({P} - {Y}) / (AVG({Y}) + 1e-8) * 100"
ALL = (f"ROUND({MAE}, 6) AS mae, ROUND({RMSE}, 6) AS rmse, ROUND({MAPE_C}, 0) AS mape, ROUND({SMAPE}, 6) AS smape, "
       f"ROUND({BIAS}, 6) AS bias, ROUND({BIAS_PCT}, 6) AS bias_pct")
CORE = f"ROUND({MAE}, 6) AS mae, ROUND({RMSE}, 6) AS rmse, ROUND({MAPE_N}, 6) AS mape, ROUND({BIAS}, 6) AS bias"
STEP = f"step AS (SELECT ABS({Y} - LAG({Y}, 24) OVER ({SER})) AS s FROM train)"


def _one(expr: str, name: str, digits: int = 6) -> str:
    return on_sales(f"SELECT ROUND({expr}, {digits}) AS {name} FROM preds", PREDICTIONS)


SEGMENTS = {
    "HighVolume": "product_volume > mid", "LowVolume": "product_volume <= mid",
    "PeakHours": "hour BETWEEN 17 AND 20", "OffPeakHours": "NOT (hour BETWEEN 17 AND 20)",
    "Stockout": "hours_stock_status = 0", "InStock": "hours_stock_status = 1",
}


ORACLE = {
    "impute_median": on_sales(
        f"SELECT {ROW}, " + ", ".join(
            f"ROUND(COALESCE({c}, {_sub(f'quantile_cont({c}, 0.5)')}), 6) AS {c}" for c in FEATURES) + " FROM fr",
        FEATURE_ROWS),
    "impute_constant": on_sales(f"SELECT {ROW}, {_each('COALESCE({c}, 0)')} FROM fr", FEATURE_ROWS),
    "standard_scale": on_sales(
        f"SELECT {ROW}, " + ", ".join(
            f"ROUND(({c} - {_sub(f'AVG({c})')}) / {_sub(f'STDDEV_POP({c})')}, 6) AS {c}" for c in FEATURES) + " FROM fr",
        FEATURE_ROWS),
    "robust_scale": on_sales(
        f"SELECT {ROW}, " + ", ".join(
            f"""ROUND(({c} - {_sub(f'quantile_cont({c}, 0.5)')})
              / COALESCE(NULLIF({_sub(f'quantile_cont({c}, 0.75)')} - {_sub(f'quantile_cont({c}, 0.25)')}, 0), 1), 6) AS {c}""" for c in FEATURES)
        + " FROM fr", FEATURE_ROWS),
    "finite_clean": on_sales(f"""SELECT {ROW}, CASE hour(dt) WHEN 0 THEN 0 WHEN 1 THEN 1e10 WHEN 2 THEN -1e10
        WHEN 3 THEN 0 ELSE {Y} END AS x FROM sales"""),
    "train_val_split": on_sales(f"""SELECT {ROW}, CASE WHEN {key_bucket(['store_id', 'product_id', 'epoch(dt)'], 1000)} < 200
        THEN 'validation' ELSE 'train' END AS part FROM sales"""),
    "clip_nonneg": on_sales(f"SELECT {ROW}, ROUND(GREATEST({P} - 5, 0), 6) AS {P} FROM preds", PREDICTIONS),
    "naive_last": _naive(_last()),
    "naive_seasonal_mean": _naive(ea(Y), where="back <= 24"),
    "naive_mean": _naive(ea(Y)),
    "naive_drift": _naive(
        f"GREATEST({_last()} + ({_last()} - MAX(CASE WHEN pos = 0 THEN {Y} END)) / NULLIF(COUNT(*) - 1, 0), 0)"),
    "seasonal_profile": _naive(ea(Y), group=", pos % 24 AS slot", on="AND f.slot = hour(e.dt)"),
    "simple_naive": _naive(_last(), default=MED),
    "seasonal_naive": _naive(f"MAX({Y})", default=MED, group=", dt", on="AND f.dt = e.dt - INTERVAL 168 HOUR"),
    "moving_average": _moving(),
    "mae": _one(MAE, "mae"), "rmse": _one(RMSE, "rmse"), "mape_clamped": _one(MAPE_C, "mape_clamped", 0),
    "mape_nonzero": _one(MAPE_N, "mape_nonzero"), "smape": _one(SMAPE, "smape"), "bias": _one(BIAS, "bias"),
    "bias_pct": _one(BIAS_PCT, "bias_pct"),
    "mase": on_sales(
        f"SELECT ROUND({MAE} / ((SELECT AVG(s) FROM step) + 1e-8), 6) AS mase FROM preds", PREDICTIONS, STEP),
    "all_metrics": on_sales(
        f"SELECT {ALL}, ROUND({MAE} / ((SELECT AVG(s) FROM step) + 1e-8), 6) AS mase FROM preds", PREDICTIONS, STEP),
    "metrics_by_group": on_sales(
        f"SELECT store_id, product_id, {ALL}, COUNT(*) AS n_observations FROM preds GROUP BY 1, 2", PREDICTIONS),
    **{f"metrics_by_{k}": on_sales(f"SELECT {c}, {ALL}, COUNT(*) AS n_observations FROM preds GROUP BY 1", PREDICTIONS)
       for k, c in (("store", "store_id"), ("product", "product_id"), ("category", "first_category_id"))},
    "evaluate_df": on_sales(f"SELECT {CORE} FROM preds", PREDICTIONS),
    "business_metrics": on_sales(
        "\nUNION ALL ".join(
            f"SELECT '{s}' AS segment, {CORE}, COUNT(*) AS n_observations FROM pm WHERE {c}" for s, c in SEGMENTS.items()),
        PREDICTIONS,
        "pm AS (SELECT *, (SELECT quantile_cont(product_volume, 0.5) FROM preds) AS mid FROM preds)"),
    "compare_models": on_sales(
        f"SELECT model, {CORE} FROM stacked GROUP BY 1", PREDICTIONS,
        f"""fit AS (SELECT store_id, product_id, arg_max({Y}, dt) AS l, {ea(Y)} AS m FROM train GROUP BY 1, 2),
        stacked AS (
          SELECT 'naive_last' AS model, e.{Y}, f.l AS prediction FROM ev e JOIN fit f USING (store_id, product_id)
          UNION ALL
          SELECT 'naive_mean', e.{Y}, f.m FROM ev e JOIN fit f USING (store_id, product_id)
          UNION ALL SELECT 'seasonal_naive', {Y}, prediction FROM preds)"""),
    "residuals": on_sales(
        f"SELECT {ROW}, ROUND({ERR}, 6) AS residual, ROUND(ABS({ERR}), 6) AS abs_residual FROM preds", PREDICTIONS),
    "train_r2": on_sales(
        f"SELECT ROUND(1 - SUM({ERR} * {ERR}) / (VAR_POP({Y}) * COUNT(*)), 6) AS r2 FROM preds", PREDICTIONS),
}

# The same over all series.
_LEFT_OUT = " AND NOT (store_id = 0 AND product_id = 11)"
_NAIVE = ("naive_last", "naive_seasonal_mean", "naive_mean", "naive_drift", "seasonal_profile", "simple_naive", "seasonal_naive", "moving_average")
ORACLE |= {f"{k}_all": ORACLE[k].replace(_LEFT_OUT, "") for k in _NAIVE}
