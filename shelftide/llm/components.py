"""Connected components of pairs, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.select("u", "v").union(pairs.select(F.col("v"), F.col("u")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _ordered(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(pairs: DataFrame) -> DataFrame:
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    moved = pairs.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _ordered(moved.union(least.select("u", F.col("m").alias("v"))))


def components(pairs: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``pairs (u, v)`` that is not the least of its component; ``root`` is the least.

    Each round is written to the shared folder, so lineage stays short. Rounds grow with the logarithm of a component.
    """
    now = stored(_ordered(pairs))
    state = None
    while True:
        seen = now.select(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state or not seen[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = seen
        now = stored(_small_star(_large_star(now)))
