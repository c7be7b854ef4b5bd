"""Forecast error by horizon, from rolling origins.

Every target row is forecast from the origins that lie each horizon's number of rows before it, with what was known at
the origin and nothing later. Origins are not joined to targets: what was known ``h`` rows ago is a lag of the target's
row, so all horizons of all models share one shuffle and one sort, and rows are expanded by (origin, horizon) only then.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import HORIZONS, SERIES_KEYS, TARGET
from ..functions.columns import MONEY
from ..operators.metrics import bias, mae, rmse
from ..operators.regression import moments, predicted, solved
from ..operators.series import Transform, attach, over_series

DAY, WEEK = 24, 168
#: What is known at the origin: the last value, the same hour of the last known day and week, means of a day and a week.
KNOWN = ("last", "day", "week", "mean_day", "mean_week")
#: Forecasters straight from what is known; ``drift`` goes on as the last week went.
NAIVE = (*KNOWN, "drift")


def known_columns(y: str, horizons: Sequence[int]) -> Transform:
    """Add ``_known``: per horizon the origin's time and what was known then, null where the series is too short."""

    def apply(df, parts, order):
        w = Window.partitionBy(*parts).orderBy(*order)
        up = w.rowsBetween(Window.unboundedPreceding, 0)
        before = df.columns
        df = df.withColumns({"_sum": F.sum(F.col(y).cast(MONEY)).over(up), "_seen": F.count(y).over(up), "_row": F.row_number().over(w)})
        # A mean is the difference of two running sums in fixed point: exact, and one step per row.
        means = {}
        for name, size in (("_mean_day", DAY), ("_mean_week", WEEK)):
            total = F.col("_sum") - F.coalesce(F.lag("_sum", size).over(w), F.lit(0).cast(MONEY))
            seen = F.col("_seen") - F.coalesce(F.lag("_seen", size).over(w), F.lit(0))
            means[name] = F.when(F.col("_row") >= size, total.cast("double") / F.nullif(seen, F.lit(0)))
        df = df.withColumns(means)
        known = []
        for h in horizons:
            last = F.lag(y, h).over(w)
            known.append(F.struct(
                F.lit(h).alias("horizon"), F.lag("dt", h).over(w).alias("origin"), last.alias("last"),
                F.lag(y, DAY * ceil(h / DAY)).over(w).alias("day"), F.lag(y, WEEK * ceil(h / WEEK)).over(w).alias("week"),
                F.lag("_mean_day", h).over(w).alias("mean_day"), F.lag("_mean_week", h).over(w).alias("mean_week"),
                (last + h * (last - F.lag(y, h + WEEK).over(w)) / WEEK).alias("drift")))
        return df.withColumn("_known", F.array(*known)).select(*before, "_known")

    return apply


def origin_rows(
    df: DataFrame, horizons: Sequence[int] = HORIZONS, y: str = TARGET, keys: Sequence[str] = SERIES_KEYS,
    targets: Column | None = None, **hot,
) -> DataFrame:
    """One row per (target row, horizon): keys, ``dt``, ``y``, ``origin``, ``horizon`` and what was known at the origin.

    ``targets`` chooses the target rows; those before the horizon's first origin fall away.
    """
    narrow = df.select(*keys, "dt", y)
    rows = over_series(narrow, known_columns(y, horizons), keys, lookback=max(horizons) + WEEK + DAY, **hot)
    rows = rows if targets is None else rows.filter(targets)
    return rows.select(*keys, "dt", y, F.inline("_known")).filter(F.col("origin").isNotNull())


def direct_weights(rows: DataFrame, y: str = TARGET, known: Sequence[str] = KNOWN, alpha: float = 1.0) -> DataFrame:
    """One ridge regression per horizon on what was known at the origin."""
    return solved(moments(rows, ["horizon"], y, known), len(known), alpha)


def horizon_forecasts(
    df: DataFrame, split: Column, horizons: Sequence[int] = HORIZONS, y: str = TARGET, keys: Sequence[str] = SERIES_KEYS,
    models: Sequence[str] = (*NAIVE, "direct"), alpha: float = 1.0, **hot,
) -> DataFrame:
    """Forecasts of all rows from ``split`` on: keys, ``dt``, ``y``, ``origin``, ``horizon``, ``model``, ``prediction``.

    ``direct`` is fitted per horizon on target rows before ``split``.
    """
    rows = origin_rows(df, horizons, y, keys, **hot)
    future = rows.filter(F.col("dt") >= split)
    if "direct" in models:
        past = rows.filter(F.col("dt") < split)
        # One row per horizon.
        future = attach(future, direct_weights(past, y, KNOWN, alpha), ["horizon"], len(horizons))
        future = future.withColumn("direct", predicted([F.col(c) for c in KNOWN]))
    forecasts = F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("prediction")) for m in models])
    return future.select(*keys, "dt", y, "origin", "horizon", F.inline(forecasts))


def horizon_metrics(forecasts: DataFrame, y: str = TARGET, p: str = "prediction") -> DataFrame:
    """``n``, MAE, RMSE and bias per model and horizon, over rows with a forecast."""
    a, b = F.col(y), F.col(p)
    known = forecasts.filter(a.isNotNull() & b.isNotNull())
    return known.groupBy("model", "horizon").agg(
        F.count(F.lit(1)).alias("n"), mae(a, b).alias("mae"), rmse(a, b).alias("rmse"), bias(a, b).alias("bias"))
