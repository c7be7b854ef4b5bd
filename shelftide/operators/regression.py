"""Least squares per group from merged moments.

One aggregation collects counts, means and co-moments, which combine on the map side; the normal equations of every
group are then solved by column expressions, row by row, so no group is ever gathered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def moments(df: DataFrame, keys: Sequence[str], y: str, xs: Sequence[str]) -> DataFrame:
    """Per group ``n``, means (``_m<i>``, ``_my``), covariances (``_c<i>_<j>``, ``_b<i>``) and ``_vy``.

    Rows with a null among ``y`` and ``xs`` are left out.
    """
    rows = df.dropna(subset=[y, *xs]).select(*keys, *[F.col(c).cast("double").alias(c) for c in dict.fromkeys([y, *xs])])
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(y).alias("_my"), F.var_pop(y).alias("_vy")]
    for i, x in enumerate(xs):
        aggs += [F.avg(x).alias(f"_m{i}"), F.covar_pop(x, y).alias(f"_b{i}")]
        aggs += [F.covar_pop(x, xs[j]).alias(f"_c{i}_{j}") for j in range(i + 1)]
    return rows.groupBy(*keys).agg(*aggs)


def solved(sums: DataFrame, k: int, alpha: float = 0.0, least_share: float = 1e-9) -> DataFrame:
    """Add ``w0`` to ``w<k-1>``, ``intercept`` and ``r2`` to the moments of ``k`` regressors.

    ``alpha`` is a ridge penalty on the sum of squares. Elimination runs down the diagonal; without a penalty, a
    regressor whose variance is used up by the ones before it (``least_share`` of it is left, or less) gets the weight 0.
    """
    a = lambda i, j: F.col(f"_c{max(i, j)}_{min(i, j)}")
    out = sums.withColumns({f"_a{i}_{j}": a(i, j) + (F.lit(alpha) / F.col("n") if i == j else 0) for i in range(k) for j in range(k)})
    out = out.withColumns({f"_r{i}": F.col(f"_b{i}") for i in range(k)})
    for p in range(k):
        used_up = F.col(f"_a{p}_{p}") <= F.lit(0.0 if alpha else least_share) * F.col(f"_c{p}_{p}")
        out = out.withColumn(f"_p{p}", F.when(~used_up & (F.col(f"_a{p}_{p}") > 0), 1 / F.nullif(F.col(f"_a{p}_{p}"), F.lit(0.0))).otherwise(0.0))
        step = {}
        for i in range(p + 1, k):
            ratio = F.col(f"_a{i}_{p}") * F.col(f"_p{p}")
            step |= {f"_a{i}_{j}": F.col(f"_a{i}_{j}") - ratio * F.col(f"_a{p}_{j}") for j in range(p + 1, k)}
            step[f"_r{i}"] = F.col(f"_r{i}") - ratio * F.col(f"_r{p}")
        if step:
            out = out.withColumns(step)
    for p in reversed(range(k)):
        known = [F.col(f"_a{p}_{j}") * F.col(f"w{j}") for j in range(p + 1, k)]
        out = out.withColumn(f"w{p}", (F.col(f"_r{p}") - sum(known, F.lit(0.0))) * F.col(f"_p{p}"))
    base, explained = F.col("_my"), F.lit(0.0)
    for i in range(k):
        base, explained = base - F.col(f"w{i}") * F.col(f"_m{i}"), explained + F.col(f"w{i}") * F.col(f"_b{i}")
    out = out.withColumns({"intercept": base, "r2": explained / F.nullif(F.col("_vy"), F.lit(0.0))})
    return out.select([c for c in out.columns if not c.startswith(("_a", "_r", "_p", "_c", "_b", "_m", "_v"))])


def predicted(xs: Sequence[Column], weights: str = "w", intercept: str = "intercept") -> Column:
    """Value of a solved model, its weights in columns of the row."""
    out = F.col(intercept)
    for i, x in enumerate(xs):
        out = out + F.col(f"{weights}{i}") * x
    return out
