"""Writers for predictions, comparisons and run records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

PREDICTION_COLUMNS = ("store_id", "product_id", "dt", "prediction")


def write_predictions(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    out = df.select(*PREDICTION_COLUMNS).write.mode(mode)
    if fmt == "csv":
        out.option("header", True).csv(path)
    elif fmt == "parquet":
        out.parquet(path)
    else:
        raise ValueError(f"unknown format: {fmt}")


def write_comparison(metrics: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One row per model."""
    metrics.coalesce(1).write.mode(mode).option("header", True).csv(path)


def write_results(record: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One run record."""
    record.coalesce(1).write.mode(mode).json(path)


def write_sorted(df: DataFrame, path: str, keys: Sequence[str] = ("store_id", "product_id", "dt")) -> None:
    """Fact table ordered by series and time, so readers can skip row groups."""
    from .sales import sort_series

    sort_series(df, keys).write.mode("overwrite").parquet(path)
