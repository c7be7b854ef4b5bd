"""Stores grouped by the shape of their week.

A store's profile is the share of its sales in each hour of the week: one row of ``SLOTS`` numbers per store, from one
aggregation with map-side sums. Centres are found by k-means with a seeded k-means|| start; the driver and the tasks hold the
``k`` centres only, however many stores there are. Clusters are numbered by size, the largest first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SEED, TARGET
from ..functions.columns import exact_sum

SLOTS = 168
STORE = "store_id"


def week_profiles(df: DataFrame, y: str = TARGET, store: str = STORE) -> DataFrame:
    """``store``, ``total`` and ``profile``: the shares of the hours of the week, Monday midnight first.

    A store without sales has the share 0 in every hour. Rows without a store or a time are left out.
    """
    slot = F.weekday("dt") * 24 + F.hour("dt")
    sums = df.filter(F.col(store).isNotNull() & F.col("dt").isNotNull()).groupBy(store, slot.alias("_slot")).agg(F.coalesce(exact_sum(y), F.lit(0.0)).alias("_sum"))
    whole = sums.groupBy(store).agg(F.map_from_entries(F.collect_list(F.struct("_slot", "_sum"))).alias("_sums"), exact_sum("_sum").alias("total"))
    share = lambda k: F.coalesce(F.element_at("_sums", k.cast("int")) / F.nullif(F.col("total"), F.lit(0.0)), F.lit(0.0))
    return whole.select(store, "total", F.transform(F.sequence(F.lit(0), F.lit(SLOTS - 1)), share).alias("profile"))


@dataclass
class StoreClusters:
    """Centres of a fit, by number of their cluster."""

    centres: list[list[float]]
    store: str = STORE

    def centre_rows(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(k, [float(x) for x in c]) for k, c in enumerate(self.centres)], "cluster int, centre array<double>")

    def transform(self, profiles: DataFrame) -> DataFrame:
        """``profiles`` with ``cluster`` and ``distance`` to its centre; the smaller number of two equally near."""
        def off(centre: list[float]):
            gaps = F.zip_with("profile", F.array(*[F.lit(float(x)) for x in centre]), lambda a, b: (a - b) * (a - b))
            return F.aggregate(gaps, F.lit(0.0), lambda at, x: at + x)

        tries = F.array(*[F.struct(F.sqrt(off(c)).alias("distance"), F.lit(k).alias("cluster")) for k, c in enumerate(self.centres)])
        return profiles.withColumn("_near", F.array_min(tries)).select(*profiles.columns, "_near.cluster", "_near.distance")


def fit_store_clusters(profiles: DataFrame, k: int = 4, seed: int = SEED, max_iter: int = 50, store: str = STORE) -> StoreClusters:
    """Centres of ``k`` clusters. Up to ``k`` different profiles are their own centres.

    Rows are dealt out and ordered by store before the start is drawn, so the same stores give the same centres.
    """
    rows = profiles.repartition(store).sortWithinPartitions(store).select("profile", array_to_vector("profile").alias("features"))
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # At most k + 1 rows.
        different = rows.groupBy("profile").agg(F.count(F.lit(1)).alias("n")).limit(k + 1).collect()
        if len(different) <= k:
            ranked = sorted(different, key=lambda r: (-r["n"], r["profile"]))
            return StoreClusters([list(r["profile"]) for r in ranked], store)
        fitted = KMeans(k=k, seed=seed, maxIter=max_iter, tol=1e-9, initMode="k-means||").fit(rows)
        sizes = fitted.summary.clusterSizes
        centres = fitted.clusterCenters()
    finally:
        rows.unpersist()
    ranked = sorted(range(len(centres)), key=lambda i: (-sizes[i], list(centres[i])))
    return StoreClusters([list(map(float, centres[i])) for i in ranked], store)
