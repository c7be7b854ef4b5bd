"""Binned features, condition flags and filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DISCOUNT_BINS, PRECIP_BINS, TEMP_BINS
from ..functions.columns import binned, flag


def temp_category(df: DataFrame, temperature: str = "avg_temperature", bins=TEMP_BINS) -> DataFrame:
    return df.withColumn("temp_category", binned(temperature, bins))


def precip_category(df: DataFrame, precipitation: str = "precpt", bins=PRECIP_BINS) -> DataFrame:
    return df.withColumn("precip_category", binned(precipitation, bins))


def discount_category(
    df: DataFrame, discount: str = "discount", scale: float = 100.0, bins=DISCOUNT_BINS
) -> DataFrame:
    """The bins are in percent; ``scale`` turns the stored unit into percent."""
    # Rounded so that a fraction such as 0.28 gives 28 and not its neighbour.
    percent = F.round(F.col(discount) * F.lit(float(scale)), 9)
    return df.withColumn("discount_category", binned(percent, bins))


def hot_weekend_afternoon(df: DataFrame) -> DataFrame:
    cond = (F.col("temp_category") == "hot") & (F.col("day_of_week") >= 5) & F.col("hour").between(12, 18)
    return df.withColumn("hot_weekend_afternoon", flag(cond))


def rainy_morning_discount(df: DataFrame) -> DataFrame:
    cond = (F.col("precip_category") == "moderate") & F.col("hour").between(6, 12) & (F.col("discount") > 0)
    return df.withColumn("rainy_morning_discount", flag(cond))


def fill_features(df: DataFrame, columns: Sequence[str], value: float = 0.0) -> DataFrame:
    """Fill the named columns that exist."""
    present = [c for c in columns if c in df.columns]
    return df.fillna(value, subset=present) if present else df


def fill_all_zero(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Fill every numeric column with 0, except keys, labels and other columns in ``keep``."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in keep]
    return df.fillna(0, subset=numeric) if numeric else df
