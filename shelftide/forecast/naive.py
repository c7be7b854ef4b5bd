"""Naive forecasters: a fitted table per series, joined back to predict."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import WINDOWS
from ..functions.columns import exact_avg
from ..operators.quantiles import median_of
from ..operators.series import HOT_ROWS, attach, distinct_keys, with_position
from .base import SERIES, Forecaster, Model, require, write_json

Y = "sale_amount"
STRATEGIES = ("last", "seasonal", "mean", "drift")


@dataclass
class TableModel(Model):
    """Values per key, a default for keys without one, and how to build the key of a row."""

    table: DataFrame = None
    keys: tuple[str, ...] = tuple(SERIES)
    n_keys: int = 0
    default: float = 0.0
    clip: bool = False
    lookup: str = "series"

    def __post_init__(self):
        # One small row per key: computed once, and read by every later transform.
        if self.table is not None:
            self.table = self.table.persist(StorageLevel.MEMORY_AND_DISK)

    def release(self) -> None:
        """Gives back the room of the fitted table; it is computed anew if used again."""
        self.table.unpersist()

    def transform(self, df: DataFrame) -> DataFrame:
        require(df, SERIES)
        kept = df.columns
        if self.lookup == "series":
            found = attach(df, self.table, self.keys, self.n_keys)
        else:
            require(df, ["dt"])
            found = attach(
                df.withColumn("_slot", _slot(self.lookup)), self.table, self.keys, self.n_keys,
                spread=self.lookup.startswith("back"),
            )
        value = F.coalesce("_value", F.lit(self.default))
        if self.clip:
            value = F.greatest(value, F.lit(0.0))
        return found.select(*kept, value.alias("prediction"))

    def save(self, spark: SparkSession, path: str) -> None:
        about = {
            "family": "naive", "name": self.name, "config": self.config, "keys": list(self.keys),
            "n_keys": self.n_keys, "default": self.default, "clip": self.clip, "lookup": self.lookup,
        }
        self.table.write.mode("overwrite").parquet(f"{path}/table")
        write_json(spark, about, f"{path}/about")


def load(spark: SparkSession, path: str, meta: dict) -> TableModel:
    return TableModel(
        name=meta["name"], config=meta["config"], table=spark.read.parquet(f"{path}/table"),
        keys=tuple(meta["keys"]), n_keys=meta["n_keys"], default=meta["default"],
        clip=meta["clip"], lookup=meta["lookup"],
    )


def _slot(lookup: str) -> Column:
    kind, n = lookup.split(":")
    if kind == "hour":
        return F.pmod(F.hour("dt"), F.lit(int(n))).cast("long")
    # Exact time some hours back.
    return F.timestamp_add("HOUR", F.lit(-int(n)), F.col("dt"))


def _nonneg(value: Column) -> Column:
    return F.greatest(F.coalesce(value, F.lit(0.0)), F.lit(0.0))


def _median(df: DataFrame, fallback: float | None) -> float:
    if fallback is not None:
        return float(fallback)
    value = median_of(df, Y).first()[0]  # one number
    return 0.0 if value is None else float(value)


@dataclass
class Naive(Forecaster):
    """Last value, mean of the last period, mean, or drift. Unseen series give 0."""

    strategy: str = "seasonal"
    period: int = 24

    def __post_init__(self):
        if self.strategy not in STRATEGIES:
            raise ValueError(f"unknown strategy: {self.strategy}, choose from {STRATEGIES}")

    def fit(self, df: DataFrame) -> TableModel:
        require(df, [*SERIES, "dt", Y])
        df = df.dropna(subset=SERIES)
        build: Callable[[DataFrame], DataFrame] = getattr(self, f"_{self.strategy}")
        table = build(df.select(*SERIES, "dt", Y))
        return TableModel(
            name=f"naive_{self.strategy}", config={"strategy": self.strategy, "period": self.period},
            table=table.select(*SERIES, _nonneg(F.col("_value")).alias("_value")),
            n_keys=distinct_keys(df, SERIES)[0], clip=True,
        )

    def _last(self, df):
        return df.groupBy(*SERIES).agg(F.max_by(Y, F.struct("dt", Y)).alias("_value"))

    def _seasonal(self, df):
        # The rank filter prunes each map task to ``period`` rows per series before the shuffle.
        newest = Window.partitionBy(*SERIES).orderBy(F.desc("dt"))
        tail = df.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= self.period)
        whole = F.count(Y) == F.count(F.lit(1))
        return tail.groupBy(*SERIES).agg(F.when(whole, exact_avg(Y)).alias("_value"))

    def _mean(self, df):
        return df.groupBy(*SERIES).agg(exact_avg(Y).alias("_value"))

    def _drift(self, df):
        last, first, n = F.max_by(Y, F.struct("dt", Y)), F.min_by(Y, F.struct("dt", Y)), F.count(F.lit(1))
        trend = F.when(n > 1, (last - first) / F.nullif(n - 1, F.lit(0))).otherwise(F.lit(0.0))
        return df.groupBy(*SERIES).agg((last + trend).alias("_value"))


@dataclass
class SeasonalProfile(Forecaster):
    """Mean per place in the season, counted in rows; predicted by the clock hour."""

    periods: Sequence[int] = (24, 168)
    hot_rows: int = HOT_ROWS

    def pattern(self, df: DataFrame, period: int) -> DataFrame:
        df = df.dropna(subset=SERIES).select(*SERIES, "dt", Y)
        placed = with_position(df, SERIES, hot_rows=self.hot_rows)
        slot = F.pmod(F.col("position"), F.lit(period)).cast("long").alias("_slot")
        return placed.groupBy(*SERIES, slot).agg(exact_avg(Y).alias("_value"))

    def fit(self, df: DataFrame) -> TableModel:
        require(df, [*SERIES, "dt", Y])
        primary = int(self.periods[0])
        return TableModel(
            name="seasonal_profile", config={"periods": list(self.periods)}, table=self.pattern(df, primary),
            keys=(*SERIES, "_slot"), n_keys=distinct_keys(df, SERIES)[0] * primary, clip=True,
            lookup=f"hour:{primary}",
        )


@dataclass
class SimpleNaive(Forecaster):
    """Last known value per series; the median of all values where there is none."""

    fallback: float | None = None

    def fit(self, df: DataFrame) -> TableModel:
        require(df, [*SERIES, "dt", Y])
        known = df.dropna(subset=[*SERIES, Y])
        return TableModel(
            name="simple_naive", table=known.groupBy(*SERIES).agg(F.max_by(Y, F.struct("dt", Y)).alias("_value")),
            n_keys=distinct_keys(known, SERIES)[0], default=_median(df, self.fallback),
        )


@dataclass
class SeasonalNaive(Forecaster):
    """The value exactly ``period`` hours earlier, else the median of all values."""

    period: int = 168
    fallback: float | None = None

    def fit(self, df: DataFrame) -> TableModel:
        require(df, [*SERIES, "dt", Y])
        past = df.dropna(subset=SERIES).select(*SERIES, F.col("dt").alias("_slot"), F.col(Y).alias("_value"))
        return TableModel(
            name="seasonal_naive", config={"period": self.period}, table=past, keys=(*SERIES, "_slot"),
            n_keys=distinct_keys(past, [*SERIES, "_slot"])[0], default=_median(df, self.fallback),
            lookup=f"back:{self.period}",
        )


@dataclass
class MovingAverage(Forecaster):
    """Recency-weighted means of the last hours of a series, one per window, combined.

    Inside a window the weights grow from exp(-1) to 1 with the place of the row.
    Windows count by 1/length unless weights are given; empty windows are left out.
    """

    windows: Sequence[int] = WINDOWS
    weights: Sequence[float] | None = None
    fallback: float | None = None
    hot_rows: int = HOT_ROWS

    def __post_init__(self):
        if self.weights is not None and len(self.weights) != len(self.windows):
            raise ValueError("weights must match windows in number")
        pairs = sorted(zip(self.windows, self.weights or [1.0 / w for w in self.windows]))
        self.windows, self.weights = [int(w) for w, _ in pairs], [float(x) for _, x in pairs]

    def fit(self, df: DataFrame) -> TableModel:
        require(df, [*SERIES, "dt", Y])
        rows = df.dropna(subset=SERIES).select(*SERIES, "dt", Y)
        n_series = distinct_keys(rows, SERIES)[0]
        ends = rows.groupBy(*SERIES).agg(F.max("dt").alias("_end"))
        age = F.unix_micros("_end") - F.unix_micros("dt")
        recent = attach(rows, ends, SERIES, n_series).filter(
            F.col(Y).isNotNull() & (age < max(self.windows) * 3_600_000_000)
        )
        inside = {w: age < w * 3_600_000_000 for w in self.windows}
        sizes = recent.groupBy(*SERIES).agg(
            F.count(F.lit(1)).alias("_n"), *[F.count(F.when(c, 1)).alias(f"_n{w}") for w, c in inside.items()]
        )
        placed = attach(with_position(recent, SERIES, name="_at", hot_rows=self.hot_rows), sizes, SERIES, n_series)
        sums = []
        for w, c in inside.items():
            n = F.col(f"_n{w}")
            place = (F.col("_at") - (F.col("_n") - n)) / F.nullif(n - 1, F.lit(0))
            weight = F.when(c, F.exp(F.coalesce(place, F.lit(0.0)) - 1))
            sums.append((F.sum(F.col(Y) * weight) / F.sum(weight)).alias(f"_m{w}"))
        means = placed.groupBy(*SERIES).agg(*sums)
        total = sum((F.when(F.col(f"_m{w}").isNotNull(), F.lit(x)).otherwise(0.0) for w, x in zip(self.windows, self.weights)), F.lit(0.0))
        value = sum((F.coalesce(F.col(f"_m{w}") * x, F.lit(0.0)) for w, x in zip(self.windows, self.weights)), F.lit(0.0))
        table = means.select(*SERIES, (value / F.nullif(total, F.lit(0.0))).alias("_value"))
        return TableModel(
            name="moving_average", config={"windows": list(self.windows), "weights": list(self.weights)},
            table=table, n_keys=n_series, default=_median(df, self.fallback),
        )
