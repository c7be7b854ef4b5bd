"""Dense rank inside groups that may hold a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import magnitude_bucket
from .series import attach


def dense_rank_desc(
    df: DataFrame, keys: Sequence[str], value: str, name: str, source: DataFrame | None = None
) -> DataFrame:
    """Add the dense rank of ``value`` within ``keys``, largest first; null stays null.

    Rows are reduced to the distinct values of a group, those are counted per bucket
    of value, and a value's rank is the number of distinct values in higher buckets
    plus its rank in its own. No task orders a whole group. ``source`` is a cheaper
    frame with the same keys and values to rank from.
    """
    source = df if source is None else source
    rows = source.select(*keys, (F.col(value) + F.lit(0.0)).alias("_v")).filter(F.col("_v").isNotNull())
    # Two numbers from one pass of sketches.
    middle, n_values = rows.agg(F.percentile_approx("_v", 0.5, 1000), F.approx_count_distinct(F.struct(*keys, "_v"))).first()
    # Buckets are fine near the middle and coarse far from it, so no outlier on either side makes them few.
    values = rows.distinct().withColumn("_b", magnitude_bucket(F.col("_v") - F.lit(middle)))
    down = Window.partitionBy(*keys).orderBy(F.desc("_b"))
    above = (
        values.groupBy(*keys, "_b")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*keys, "_b", (F.sum("_n").over(down) - F.col("_n")).alias("_above"))
    )
    inside = Window.partitionBy(*keys, "_b").orderBy(F.desc("_v"))
    ranked = values.join(above, [*keys, "_b"]).select(
        *keys, "_v", (F.col("_above") + F.dense_rank().over(inside)).cast("long").alias(name)
    )
    rows = df.withColumn("_v", F.col(value) + F.lit(0.0))
    return attach(rows, ranked, [*keys, "_v"], n_values).select(*df.columns, name)
