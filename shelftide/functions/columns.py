"""Column expressions shared by the operators."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_sum(c: Column | str) -> Column:
    """Sum in fixed point, so the result does not depend on the order of rows."""
    return F.sum(col(c).cast(MONEY)).cast("double")


def exact_avg(c: Column | str) -> Column:
    return exact_sum(c) / F.nullif(F.count(col(c)), F.lit(0))


def exact_avg_when(cond: Column, c: Column | str) -> Column:
    return exact_avg(F.when(cond, col(c)))


def exact_sum_when(cond: Column, c: Column | str) -> Column:
    """Conditional sum with 0 for rows outside the condition."""
    return exact_sum(F.when(cond, col(c)).otherwise(F.lit(0.0)))


def count_when(cond: Column) -> Column:
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def share(flag: Column | str) -> Column:
    """Mean of a 0/1 column from integer counts."""
    return F.sum(col(flag)) / F.nullif(F.count(col(flag)), F.lit(0))


def flag(cond: Column) -> Column:
    """Condition as 0/1 with an unknown condition counted as 0."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def weekday_sunday0(c: Column | str) -> Column:
    return (F.dayofweek(col(c)) - 1).cast("int")


def weekday_monday0(c: Column | str) -> Column:
    return F.weekday(col(c)).cast("int")


def seconds(c: Column | str) -> Column:
    """Seconds since the epoch with the fraction kept."""
    return F.unix_micros(col(c).cast("timestamp")) / F.lit(1_000_000.0)


def hour_cell(c: Column | str) -> Column:
    """Whole hours since the epoch."""
    return F.floor(F.unix_seconds(col(c).cast("timestamp")) / F.lit(3600))


def binned(c: Column | str, bins: Iterable[tuple[float | None, str]]) -> Column:
    """Label of the right-closed bin a value falls in; null stays null."""
    value = col(c)
    out = None
    for upper, label in bins:
        cond = value.isNotNull() if upper is None else value <= F.lit(upper)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def cycle(c: Column, period: float) -> tuple[Column, Column]:
    angle = F.lit(2 * math.pi) * c / F.lit(period)
    return F.sin(angle), F.cos(angle)


def no_nan(c: Column | str) -> Column:
    value = col(c)
    return F.when(~F.isnan(value), value)


def same_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    """Null-safe equality of the key columns of two aliased frames."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return cond
