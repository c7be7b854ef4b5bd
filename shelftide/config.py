"""Typed settings. Open interval ends are ``None``."""

from __future__ import annotations

from dataclasses import dataclass, field

# Column names of the sales fact table.
SERIES_KEYS = ("store_id", "product_id")
DT = "dt"
TARGET = "sale_amount"
STOCK = "hours_stock_status"

# Lag lists, window lengths and seasonal periods, counted in rows.
SHORT_LAGS = (1, 2, 3, 7, 14, 21)
LONG_LAGS = (1, 2, 3, 6, 24, 48, 168)
MODEL_LAGS = (1, 7, 168)
STOCKOUT_LAG_MAX = 7
WINDOWS = (6, 24, 168)
SEASONAL_PERIODS = (24, 168)
VELOCITY_WINDOW = 7
HORIZONS = (1, 6, 24, 168)

# Right-closed bins, as (upper bound, label).
TEMP_BINS = ((10.0, "cold"), (25.0, "mild"), (None, "hot"))
PRECIP_BINS = ((0.0, "none"), (2.0, "light"), (5.0, "moderate"), (None, "heavy"))
DISCOUNT_BINS = ((0.0, "none"), (10.0, "small"), (20.0, "medium"), (None, "large"))
STAGE_BINS = ((10.0, "new"), (50.0, "mature"), (None, "declining"))

OUTLIER_Z = 3.0
SEED = 42


@dataclass(frozen=True)
class FeatureSettings:
    """``lags`` are those of the model features; ``fill_value`` stands for lags before a series begins."""

    lags: tuple[int, ...] = MODEL_LAGS
    seasonal_periods: tuple[int, ...] = SEASONAL_PERIODS
    fill_value: float = 0.0


@dataclass(frozen=True)
class NaiveSettings:
    seasonal_period: int = 24
    weekly_period: int = 168
    windows: tuple[int, ...] = WINDOWS
    weights: tuple[float, ...] | None = None


@dataclass(frozen=True)
class LinearSettings:
    alpha: float = 1.0
    l1_ratio: float = 0.5
    impute: str = "median"
    scaling: str | None = "standard"


@dataclass(frozen=True)
class TreeSettings:
    """``None`` leaves a value to the kind of tree."""

    num_trees: int | None = None
    max_depth: int | None = None
    min_leaf: int | None = None
    learning_rate: float = 0.1
    subsample: float = 0.8
    feature_subset: str | None = None
    impute: str = "median"


@dataclass(frozen=True)
class TrainSettings:
    """``test_size`` is held out of a fit for its training record; ``sample_fraction`` takes whole series."""

    test_size: float = 0.2
    folds: int = 5
    seed: int = SEED
    sample_fraction: float = 1.0


@dataclass(frozen=True)
class Settings:
    features: FeatureSettings = field(default_factory=FeatureSettings)
    naive: NaiveSettings = field(default_factory=NaiveSettings)
    linear: LinearSettings = field(default_factory=LinearSettings)
    tree: TreeSettings = field(default_factory=TreeSettings)
    train: TrainSettings = field(default_factory=TrainSettings)
