"""Preparation of model inputs. Parameters are fitted exactly, as aggregates."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SEED
from ..schema import numeric_columns as _numeric
from .quantiles import percentile_row, quantile_name

log = logging.getLogger(__name__)

# Modulus and multiplier of the classic minimal standard generator.
MODULUS = 2147483647
MULTIPLIER = 48271


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric feature columns; the rest are named in the log."""
    kept = _numeric(df.schema, tuple(exclude))
    dropped = [c for c in df.columns if c not in kept and c not in exclude]
    if dropped:
        log.warning("dropped non-numeric columns: %s", dropped)
    return kept


def _one_row_struct(df: DataFrame) -> Column:
    return df.select(F.struct(*df.columns).alias("s")).scalar()


def medians(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    row = percentile_row(df.select(*cols), cols, [0.5])
    return row.select(*[F.col(quantile_name(c, 0.5)).alias(c) for c in cols])


def impute_median(train: DataFrame, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fill nulls with the median of the training rows; 0 where training has no value."""
    fitted = _one_row_struct(medians(train, cols))
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), fitted.getField(c), F.lit(0.0)) for c in cols})


def impute_constant(df: DataFrame, cols: Sequence[str], value: float = 0.0) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(float(value))) for c in cols})


def scale_parameters(train: DataFrame, cols: Sequence[str], method: str) -> DataFrame:
    """One row: centre and scale per column; a scale of 0 becomes 1."""
    def safe(c: Column) -> Column:
        return F.when(c.isNull() | (c == 0), F.lit(1.0)).otherwise(c)

    if method == "standard":
        return train.agg(
            *[F.avg(c).cast("double").alias(f"{c}_centre") for c in cols],
            *[safe(F.stddev_pop(c)).alias(f"{c}_scale") for c in cols],
        )
    if method == "robust":
        row = percentile_row(train.select(*cols), cols, [0.25, 0.5, 0.75])
        return row.select(
            *[F.col(quantile_name(c, 0.5)).alias(f"{c}_centre") for c in cols],
            *[safe(F.col(quantile_name(c, 0.75)) - F.col(quantile_name(c, 0.25))).alias(f"{c}_scale") for c in cols],
        )
    raise ValueError(f"unknown scaling method: {method}")


def scale(train: DataFrame, df: DataFrame, cols: Sequence[str], method: str = "standard") -> DataFrame:
    fitted = _one_row_struct(scale_parameters(train, cols, method))
    return df.withColumns(
        {c: (F.col(c) - fitted.getField(f"{c}_centre")) / fitted.getField(f"{c}_scale") for c in cols}
    )


def finite(c: Column) -> Column:
    """NaN and null to 0, infinities to a large finite number."""
    return (
        F.when(c.isNull() | F.isnan(c), F.lit(0.0))
        .when(c == F.lit(float("inf")), F.lit(1e10))
        .when(c == F.lit(float("-inf")), F.lit(-1e10))
        .otherwise(c)
    )


def finite_clean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: finite(F.col(c).cast("double")) for c in cols})


def key_bucket(keys: Sequence[Column | str], buckets: int, seed: int = SEED) -> Column:
    """Bucket of a row from integer keys alone, the same however the data is partitioned."""
    h = F.lit(int(seed)).cast("long")
    for k in keys:
        value = F.pmod((F.col(k) if isinstance(k, str) else k).cast("long"), F.lit(MODULUS))
        h = F.pmod(h * MULTIPLIER + value, F.lit(MODULUS))
    # Squaring keeps runs of consecutive keys from landing in runs of buckets.
    h = F.pmod(F.pmod(h * h, F.lit(MODULUS)) * MULTIPLIER, F.lit(MODULUS))
    return F.pmod(h, F.lit(buckets)).cast("int")


def row_keys(store: str = "store_id", product: str = "product_id", dt: str = "dt") -> list[Column]:
    return [
        F.coalesce(F.col(store), F.lit(-1)), F.coalesce(F.col(product), F.lit(-1)),
        F.coalesce(F.unix_seconds(F.col(dt).cast("timestamp")), F.lit(-1)),
    ]


def train_val_split(
    df: DataFrame, test_size: float = 0.2, seed: int = SEED, keys: Sequence[Column | str] | None = None
) -> tuple[DataFrame, DataFrame]:
    bucket = key_bucket(keys or row_keys(), 1000, seed)
    held = bucket < round(test_size * 1000)
    return df.filter(~held), df.filter(held)


def fold_column(df: DataFrame, folds: int = 5, seed: int = SEED, name: str = "fold") -> DataFrame:
    return df.withColumn(name, key_bucket(row_keys(), folds, seed + 1))


def clip_nonneg(df: DataFrame, prediction: str = "prediction") -> DataFrame:
    return df.withColumn(prediction, F.greatest(F.nanvl(F.col(prediction), F.lit(0.0)), F.lit(0.0)))
