"""Products that sell instead of each other, and what a substitute's discount does to a product.

Pairs come from sales that share a (store, hour) cell. Only sold products stand in a cell, and products sold in fewer cells
than the wanted support are left out before any pair is made: a pair is sold together at most as often as either of its
products, so no wanted pair is lost. Products of a category fall into chunks of about ``CHUNK``, and a cell makes its pairs
chunk by chunk, in different tasks. Products of a pair are summed on the map side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import TARGET
from ..functions.columns import no_nan
from .regression import moments, solved
from .series import attach

CATEGORY, PRODUCT = "first_category_id", "product_id"
CELL = ("store_id", "dt")
# Products of a chunk, on average.
CHUNK = 256
DIGITS = 9


def _sold(df: DataFrame, y: str, cell: Sequence[str]) -> DataFrame:
    amount = F.coalesce(no_nan(F.col(y).cast("double")), F.lit(0.0))
    return df.filter(F.col(PRODUCT).isNotNull() & F.col(CATEGORY).isNotNull()).select(CATEGORY, *cell, PRODUCT, amount.alias("_y"))


def substitutability(df: DataFrame, min_support: int = 1, y: str = TARGET, cell: Sequence[str] = CELL) -> DataFrame:
    """``first_category_id``, ``product_a`` < ``product_b``, ``support``, ``correlation``.

    ``support`` counts the cells in which both are sold, at least ``min_support``. The correlation runs over all cells in which
    the category has rows; a product without sales in a cell counts as zero there. It is null for a product that sells the same
    amount in every cell. Rows with a null product or category, and null cells' times, take no part; a product has one row per cell.
    """
    rows = _sold(df, y, cell).dropna(subset=list(cell))
    cells = rows.select(CATEGORY, *cell).distinct().groupBy(CATEGORY).agg(F.count(F.lit(1)).alias("cells"))
    sold = F.col("_y") != 0
    # One row per product.
    sums = rows.groupBy(CATEGORY, PRODUCT).agg(
        F.count_if(sold).alias("_n"), F.sum("_y").alias("_s"), F.sum(F.col("_y") * F.col("_y")).alias("_ss"))
    sums = sums.filter(F.col("_n") >= max(min_support, 1))
    chunks = sums.groupBy(CATEGORY).agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("_chunks"))
    kept = sums.select(CATEGORY, PRODUCT).join(chunks, CATEGORY)
    parts = rows.filter(sold).join(kept, [CATEGORY, PRODUCT]).withColumn("_chunk", F.pmod(F.xxhash64(PRODUCT), F.col("_chunks")))
    parts = parts.groupBy(CATEGORY, *cell, "_chunk", "_chunks").agg(F.collect_list(F.struct(F.col(PRODUCT).alias("p"), F.col("_y").alias("y"))).alias("_list"))
    # A chunk meets every chunk of its cell once, itself included.
    meet = parts.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_chunks") - 1)))
    meet = meet.groupBy(CATEGORY, *cell, F.least("_chunk", "_other").alias("_low"), F.greatest("_chunk", "_other").alias("_high")).agg(
        F.max(F.when(F.col("_chunk") == F.least("_chunk", "_other"), F.col("_list"))).alias("_a"),
        F.max(F.when(F.col("_chunk") == F.greatest("_chunk", "_other"), F.col("_list"))).alias("_b"))
    same = F.col("_low") == F.col("_high")

    def with_second(x: Column) -> Column:
        others = F.filter("_b", lambda z: (z["p"] > x["p"]) | (~same & (z["p"] != x["p"])))
        return F.transform(others, lambda z: F.struct(
            F.least(x["p"], z["p"]).alias("product_a"), F.greatest(x["p"], z["p"]).alias("product_b"), (x["y"] * z["y"]).alias("_xy")))

    pairs = meet.filter(F.col("_a").isNotNull() & F.col("_b").isNotNull()).select(CATEGORY, F.inline(F.flatten(F.transform("_a", with_second))))
    pairs = pairs.groupBy(CATEGORY, "product_a", "product_b").agg(F.count(F.lit(1)).alias("support"), F.sum("_xy").alias("_xy"))
    pairs = pairs.filter(F.col("support") >= min_support).join(cells, CATEGORY)
    for side in ("a", "b"):
        pairs = pairs.join(sums.select(CATEGORY, F.col(PRODUCT).alias(f"product_{side}"), F.col("_s").alias(f"_s{side}"), F.col("_ss").alias(f"_ss{side}")), [CATEGORY, f"product_{side}"])
    n = F.col("cells")
    spread = F.sqrt((n * F.col("_ssa") - F.col("_sa") * F.col("_sa")) * (n * F.col("_ssb") - F.col("_sb") * F.col("_sb")))
    correlation = (n * F.col("_xy") - F.col("_sa") * F.col("_sb")) / F.nullif(spread, F.lit(0.0))
    return pairs.select(CATEGORY, "product_a", "product_b", "support", F.round(correlation, DIGITS).alias("correlation"))


def best_substitutes(pairs: DataFrame) -> DataFrame:
    """Per product the one it is correlated with least, the smallest id of several: one row per product of a pair."""
    both = pairs.select(F.inline(F.array(
        F.struct(F.col("product_a").alias(PRODUCT), F.col("product_b").alias("substitute_id"), "correlation"),
        F.struct(F.col("product_b").alias(PRODUCT), F.col("product_a").alias("substitute_id"), "correlation"))))
    best = both.filter(F.col("correlation").isNotNull()).groupBy(PRODUCT).agg(F.min(F.struct("correlation", "substitute_id")).alias("_best"))
    return best.select(PRODUCT, "_best.substitute_id", "_best.correlation")


def cannibalization(
    df: DataFrame, min_support: int = 1, y: str = TARGET, discount: str = "discount", cell: Sequence[str] = CELL, pairs: DataFrame | None = None,
) -> DataFrame:
    """Regression of a product's sales on its own discount and that of its best substitute in the same cell.

    ``product_id``, ``substitute_id``, ``correlation``, ``n``, ``own_effect``, ``cross_effect``, ``intercept``, ``r2`` and
    ``cannibalized``: whether the substitute's discount takes sales away. Rows where either discount is unknown don't count.
    """
    best = best_substitutes(substitutability(df, min_support, y, cell) if pairs is None else pairs)
    rows = df.select(*cell, PRODUCT, F.col(y).cast("double").alias("_y"), F.col(discount).cast("double").alias("own"))
    asked = attach(rows, best, [PRODUCT], best.count()).filter(F.col("substitute_id").isNotNull())
    others = df.select(*cell, F.col(PRODUCT).alias("substitute_id"), F.col(discount).cast("double").alias("other"))
    joined = asked.join(others, [*cell, "substitute_id"])
    keys = [PRODUCT, "substitute_id", "correlation"]
    fitted = solved(moments(joined, keys, "_y", ["own", "other"]), 2)
    return fitted.select(
        *keys, "n", F.col("w0").alias("own_effect"), F.col("w1").alias("cross_effect"), "intercept", "r2", (F.col("w1") < 0).alias("cannibalized"))
