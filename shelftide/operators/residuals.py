"""What forecast errors still hold: their autocorrelation, and lasting bias by a cumulative-sum scan.

The scan ``s = max(0, s + x)`` looks at all rows before, yet needs no step-by-step loop: it is the running sum of ``x`` less
the least value, zero included, that the sum has had so far. Both are running aggregates, so a long series is scanned in
blocks at the same time, and a block's start is put together from the sums and least values of the blocks before it. Errors
are taken in fixed point, so the result is the same however a series is cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import SERIES_KEYS
from ..functions.columns import MONEY, hour_cell
from . import series
from .series import over_series

SLACK, LIMIT = 0.5, 5.0
_SIDES = ("up", "down")


def autocorrelation(
    df: DataFrame, lags: Sequence[int] = (1, 24), residual: str = "residual", keys: Sequence[str] = SERIES_KEYS,
    order: Sequence[str] = ("dt",), **hot,
) -> DataFrame:
    """Per series ``n``, the mean residual and ``acf_<k>``; null where a series is too short or its residuals are all equal."""
    r = F.col(residual).cast("double")
    rows = df.filter(r.isNotNull() & ~F.isnan(r)).select(*keys, *order, r.alias("_r"))

    def lagged(d, parts, along):
        w = Window.partitionBy(*parts).orderBy(*along)
        return d.withColumns({f"_l{k}": F.lag("_r", k).over(w) for k in lags})

    rows = over_series(rows, lagged, keys, order, lookback=max(lags), **hot)
    sums = [F.count(F.lit(1)).alias("n"), F.avg("_r").alias("bias"), F.var_pop("_r").alias("_v")]
    for k in lags:
        pair = F.col(f"_l{k}").isNotNull()
        sums += [F.sum(F.col("_r") * F.col(f"_l{k}")).alias(f"_p{k}"), F.sum(F.when(pair, F.col("_r") + F.col(f"_l{k}"))).alias(f"_s{k}"), F.count(f"_l{k}").alias(f"_n{k}")]
    per = rows.groupBy(*keys).agg(*sums)
    m = F.col("bias")
    acf = {
        f"acf_{k}": (F.col(f"_p{k}") - m * F.col(f"_s{k}") + F.col(f"_n{k}") * m * m) / F.nullif(F.col("n") * F.col("_v"), F.lit(0.0)) for k in lags}
    return per.withColumns(acf).select(*keys, "n", "bias", *acf)


def cumulative_bias(
    df: DataFrame, residual: str = "residual", keys: Sequence[str] = SERIES_KEYS, order: Sequence[str] = ("dt",),
    slack: float = SLACK, limit: float = LIMIT, *, hot_rows: int = series.HOT_ROWS, block_rows: int = series.BLOCK_ROWS, cell=None,
) -> DataFrame:
    """The rows with ``cusum_up`` and ``cusum_down``: how far residuals above or below ``slack`` have added up since the last
    time they were made up for; ``cusum_limit``; and ``cusum_alarm``, 1 or -1 where one of them passes the limit.

    Slack and limit are in standard deviations of the series, rounded to the fixed point. A null residual counts as zero.
    """
    r = F.coalesce(F.col(residual).cast(MONEY), F.lit(0).cast(MONEY))
    spread = df.groupBy(*keys).agg(F.stddev_pop(residual).alias("_spread"))
    # One row per series.
    rows = series.attach(df, spread, keys, series.distinct_keys(df, list(keys))[0])
    fixed = lambda share: F.coalesce(F.round(F.col("_spread") * share, 4), F.lit(0.0)).cast(MONEY)
    rows = rows.withColumns({"_slack": fixed(slack), "cusum_limit": fixed(limit)}).withColumns({"_x_up": r - F.col("_slack"), "_x_down": -r - F.col("_slack")})
    if series.longest_group(df, keys) <= hot_rows:
        cut = rows.withColumn("_block", F.lit(0).cast("long")).withColumn("_pos", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    else:
        placed = series.positions(series.written(rows), keys, order, hour_cell("dt") if cell is None else cell)
        cut = placed.withColumn("_block", F.floor(F.col("_pos") / block_rows))
    here = Window.partitionBy(*keys, "_block").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    cut = cut.withColumns({f"_sum_{s}": F.sum(f"_x_{s}").over(here) for s in _SIDES})
    cut = cut.withColumns({f"_low_{s}": F.min(f"_sum_{s}").over(here) for s in _SIDES})
    blocks = cut.groupBy(*keys, "_block").agg(
        *[F.sum(f"_x_{s}").alias(f"_all_{s}") for s in _SIDES], *[F.min(f"_sum_{s}").alias(f"_least_{s}") for s in _SIDES])
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    nothing = F.lit(0).cast("decimal(38,4)")
    blocks = blocks.withColumns({f"_at_{s}": F.coalesce(F.sum(f"_all_{s}").over(before), nothing) for s in _SIDES})
    blocks = blocks.withColumns({f"_floor_{s}": F.least(nothing, F.coalesce(F.min(F.col(f"_at_{s}") + F.col(f"_least_{s}")).over(before), nothing)) for s in _SIDES})
    starts = blocks.select(*keys, "_block", *[f"_{n}_{s}" for n in ("at", "floor") for s in _SIDES])
    found = cut.alias("d").join(starts.alias("o"), series.same_keys("d", "o", [*keys, "_block"])).select("d.*", *[f"o._{n}_{s}" for n in ("at", "floor") for s in _SIDES])
    height = {
        f"cusum_{s}": F.col(f"_at_{s}") + F.col(f"_sum_{s}") - F.least(F.col(f"_floor_{s}"), F.col(f"_at_{s}") + F.col(f"_low_{s}")) for s in _SIDES}
    found = found.withColumns(height)
    # A sum above the limit was not cut at zero here, so what it was a row before is known.
    passes = {
        s: (F.col("cusum_limit") > 0) & (F.col(f"cusum_{s}") > F.col("cusum_limit")) & (F.col(f"cusum_{s}") - F.col(f"_x_{s}") <= F.col("cusum_limit"))
        for s in _SIDES}
    alarm = F.when(passes["up"], 1).when(passes["down"], -1).otherwise(0)
    shown = [F.col(c).cast("double").alias(c) for c in (*height, "cusum_limit")]
    return found.select(*df.columns, *shown, alarm.alias("cusum_alarm"))


def residual_bias(df: DataFrame, lags: Sequence[int] = (1, 24), residual: str = "residual", keys: Sequence[str] = SERIES_KEYS, order: Sequence[str] = ("dt",), **options) -> DataFrame:
    """One row per series: mean, autocorrelation, and where the cumulative sums pass their limit first and how often."""
    scanned = cumulative_bias(df, residual, keys, order, **options)
    alarms = scanned.groupBy(*keys).agg(
        *[F.max(f"cusum_{s}").alias(f"max_{s}") for s in _SIDES], F.count_if(F.col("cusum_alarm") != 0).alias("n_alarms"),
        F.min(F.when(F.col("cusum_alarm") != 0, F.col(order[0]))).alias("first_alarm"))
    acf = autocorrelation(df, lags, residual, keys, order)
    return acf.alias("d").join(alarms.alias("o"), series.same_keys("d", "o", keys)).select("d.*", *[f"o.{c}" for c in alarms.columns if c not in keys])
