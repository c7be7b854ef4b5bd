"""Forecast metrics as one-pass aggregates over (actual, prediction) rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import SERIES_KEYS
from .quantiles import median_of
from .series import over_series

Y = "sale_amount"
P = "prediction"
EPS = 1e-8
PEAK_HOURS = (17, 18, 19, 20)
SEGMENTS = ("HighVolume", "LowVolume", "PeakHours", "OffPeakHours", "Stockout", "InStock")


def mae(y: Column, p: Column) -> Column:
    return F.avg(F.abs(y - p))


def rmse(y: Column, p: Column) -> Column:
    return F.sqrt(F.avg((y - p) * (y - p)))


def mape_clamped(y: Column, p: Column) -> Column:
    return F.avg(F.abs((y - p) / F.greatest(F.abs(y), F.lit(EPS)))) * 100


def mape_nonzero(y: Column, p: Column) -> Column:
    return F.avg(F.when(y != 0, F.abs((y - p) / F.nullif(y, F.lit(0.0))))) * 100


def smape(y: Column, p: Column) -> Column:
    return F.avg(F.abs(y - p) / ((F.abs(y) + F.abs(p)) / 2 + F.lit(EPS))) * 100


def bias(y: Column, p: Column) -> Column:
    return F.avg(p - y)


def bias_pct(y: Column, p: Column) -> Column:
    return bias(y, p) / (F.avg(y) + F.lit(EPS)) * 100


SINGLE = {
    "mae": mae, "rmse": rmse, "mape_clamped": mape_clamped, "mape_nonzero": mape_nonzero,
    "smape": smape, "bias": bias, "bias_pct": bias_pct,
}


def single_metric(df: DataFrame, metric: str, y: str = Y, p: str = P) -> DataFrame:
    return df.agg(SINGLE[metric](F.col(y), F.col(p)).alias(metric))


def _all(y: str, p: str) -> list[Column]:
    a, b = F.col(y), F.col(p)
    return [
        mae(a, b).alias("mae"), rmse(a, b).alias("rmse"), mape_clamped(a, b).alias("mape"),
        smape(a, b).alias("smape"), bias(a, b).alias("bias"), bias_pct(a, b).alias("bias_pct"),
    ]


def _core(y: Column, p: Column) -> list[Column]:
    return [mae(y, p).alias("mae"), rmse(y, p).alias("rmse"), mape_nonzero(y, p).alias("mape"), bias(y, p).alias("bias")]


def naive_mae(train: DataFrame, period: int = 1, y: str = Y, keys: Sequence[str] = SERIES_KEYS, **hot) -> DataFrame:
    """Mean absolute step of ``period`` rows within a series, over the training rows."""

    def step(df, parts, order):
        w = Window.partitionBy(*parts).orderBy(*order)
        return df.withColumn("_step", F.abs(F.col(y) - F.lag(y, period).over(w)))

    steps = over_series(train.select(*keys, "dt", y), step, keys, lookback=period, **hot)
    return steps.agg(
        F.avg("_step").alias("naive_mae"), F.count(F.lit(1)).alias("n_train"), F.avg(y).alias("mean_train")
    )


def mase(df: DataFrame, train: DataFrame, period: int = 1, y: str = Y, p: str = P, **hot) -> DataFrame:
    """MAE over the naive MAE of the training rows.

    With no more training rows than the period, the training mean is the naive forecast.
    """
    base = naive_mae(train, period, y, **hot)
    base = base.select(F.struct(*base.columns).alias("b")).scalar()
    a, b = F.col(y), F.col(p)
    short = df.agg(mae(a, b).alias("mae"), F.avg(F.abs(a - base.getField("mean_train"))).alias("to_mean"))
    scale = F.when(base.getField("n_train") <= period, F.col("to_mean")).otherwise(base.getField("naive_mae"))
    return short.select((F.col("mae") / (scale + F.lit(EPS))).alias("mase"))


def all_metrics(df: DataFrame, train: DataFrame | None = None, period: int = 1, y: str = Y, p: str = P) -> DataFrame:
    out = df.agg(*_all(y, p))
    if train is None:
        return out
    return out.withColumn("mase", mase(df, train, period, y, p).scalar())


def metrics_by_group(df: DataFrame, keys: Sequence[str], y: str = Y, p: str = P) -> DataFrame:
    """All metrics per group; rows with a null key belong to no group."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(*_all(y, p), F.count(F.lit(1)).alias("n_observations"))


def evaluate(df: DataFrame, y: str = Y, p: str = P) -> DataFrame:
    return df.agg(*_core(F.col(y), F.col(p)))


def business_metrics(
    df: DataFrame, y: str = Y, p: str = P, volume: str = "product_volume", stock: str = "hours_stock_status",
    hour: str = "hour",
) -> DataFrame:
    """Core metrics in six segments, always six rows; an empty segment has null metrics.

    The segments overlap, so rows are first summed per volume half, peak and stock
    status: at most 18 sums, from which every segment is put together.
    """
    middle = F.lit(median_of(df, volume).first()[0]).cast("double")  # one number
    a, b = F.col(y), F.col(p)
    error = b - a
    both = error.isNotNull()
    cells = df.groupBy(
        (F.col(volume) > middle).alias("_high"),
        F.coalesce(F.col(hour).isin(*PEAK_HOURS), F.lit(False)).alias("_peak"),
        F.when(F.col(stock).isin(0, 1), F.col(stock)).alias("_stock"),
    ).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count(F.when(both, 1)).alias("_n"),
        F.sum(F.abs(error)).alias("_abs"),
        F.sum(error * error).alias("_square"),
        F.sum(error).alias("_error"),
        F.count(F.when(both & (a != 0), 1)).alias("_n_share"),
        F.sum(F.when(a != 0, F.abs(error / F.nullif(a, F.lit(0.0))))).alias("_share"),
    )
    member = {
        "HighVolume": F.col("_high"), "LowVolume": ~F.col("_high"),
        "PeakHours": F.col("_peak"), "OffPeakHours": ~F.col("_peak"),
        "Stockout": F.col("_stock") == 0, "InStock": F.col("_stock") == 1,
    }
    sums = []
    for name, cond in member.items():
        def total(c: str) -> Column:
            return F.sum(F.when(cond, F.col(c)))

        n = F.nullif(total("_n"), F.lit(0))
        sums.append(F.struct(
            F.lit(name).alias("segment"),
            (total("_abs") / n).alias("mae"), F.sqrt(total("_square") / n).alias("rmse"),
            (total("_share") / F.nullif(total("_n_share"), F.lit(0)) * 100).alias("mape"),
            (total("_error") / n).alias("bias"),
            F.coalesce(total("_rows"), F.lit(0)).alias("n_observations"),
        ).alias(name))
    return cells.agg(*sums).select(F.inline(F.array(*member)))


def compare_models(predictions: DataFrame, y: str = Y, p: str = P, model: str = "model") -> DataFrame:
    """Core metrics per model of predictions stacked with a ``model`` column."""
    return predictions.groupBy(model).agg(*_core(F.col(y), F.col(p)))


def residuals(df: DataFrame, y: str = Y, p: str = P) -> DataFrame:
    error = F.col(y) - F.col(p)
    return df.withColumns({"residual": error, "abs_residual": F.abs(error)})


def r2(df: DataFrame, y: str = Y, p: str = P) -> DataFrame:
    """Share of variance explained."""
    a, b = F.col(y), F.col(p)
    paired = F.when(b.isNotNull(), a)
    return df.agg(
        (1 - F.sum((a - b) * (a - b)) / F.nullif(F.var_pop(paired) * F.count(paired), F.lit(0.0))).alias("r2")
    )
