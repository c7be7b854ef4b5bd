"""Tree forecasters: single tree, forest, gradient boosting.

Spark's trees split on at most ``max_bins`` thresholds per feature found from a
sample, so they belong to the same family as exact-split libraries but do not give
the same numbers. A minimum number of rows to split a node has no counterpart and
is accepted and ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Any

from pyspark.ml.regression import (
    DecisionTreeRegressionModel,
    DecisionTreeRegressor,
    GBTRegressionModel,
    GBTRegressor,
    RandomForestRegressionModel,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_folder
from .grow import Grower, read_trees, summed
from .inputs import VECTOR
from .vector import VectorForecaster, VectorModel, load_inputs

KINDS = ("decision_tree", "random_forest", "gradient_boosting", "boosted_colsample")

# Depth, rows per leaf, features per split, number of trees.
DEFAULTS = {
    "decision_tree": (10, 10, "all", 1),
    "random_forest": (15, 5, "sqrt", 100),
    "gradient_boosting": (6, 5, "all", 100),
    "boosted_colsample": (6, 1, "0.8", 100),
}


@dataclass
class TreeModel(VectorModel):
    family: str = "tree"

    def raw(self, df: DataFrame, name: str) -> DataFrame:
        grown = getattr(self.fitted, "grown", None)
        if grown is None:
            return super().raw(df, name)
        return df.withColumn(name, grown.column(df.sparkSession, self.inputs.columns(df)))

    def save(self, spark: SparkSession, path: str) -> None:
        VectorModel.save(replace(self, fitted=getattr(self.fitted, "model", self.fitted)), spark, path)

    def importance(self) -> dict[str, float]:
        values = self.fitted.featureImportances.toArray()
        return dict(zip(self.feature_names, (float(v) for v in values)))

    def importance_detail(self, spark: SparkSession, top: int = 10) -> DataFrame:
        """Features by importance with the share of the five and ten largest; one row per feature."""
        ranked = sorted(self.importance().items(), key=lambda kv: (-kv[1], kv[0]))
        total = sum(v for _, v in ranked) or 1.0
        five, ten = (sum(v for _, v in ranked[:k]) / total for k in (5, 10))
        rows = [(f, v, i + 1, i < top, five, ten) for i, (f, v) in enumerate(ranked)]
        return spark.createDataFrame(
            rows, "feature string, importance double, rank int, in_top boolean, top_5_share double, top_10_share double"
        )

    def trees(self) -> int:
        return getattr(self.fitted, "getNumTrees", 1)


@dataclass
class Tree(VectorForecaster):
    kind: str = "random_forest"
    num_trees: int | None = None
    max_depth: int | None = None
    min_leaf: int | None = None
    min_split: int | None = None
    feature_subset: str | None = None
    learning_rate: float = 0.1
    subsample: float = 0.8
    max_bins: int = 64

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown kind: {self.kind}, choose from {KINDS}")
        depth, leaf, subset, trees = DEFAULTS[self.kind]
        self.max_depth = self.max_depth or depth
        self.min_leaf = self.min_leaf or leaf
        self.feature_subset = self.feature_subset or subset
        self.num_trees = self.num_trees or trees

    def label(self) -> str:
        return f"tree_{self.kind}"

    def model(self, **fields) -> TreeModel:
        return TreeModel(**fields)

    def estimator(self, rows: DataFrame):
        # Boosting cuts its lineage every ten rounds, and deep trees keep the node of every
        # row instead of walking from the root; both need the shared folder.
        checkpoint_folder(rows.sparkSession)
        deep = self.max_depth > 8 and self.kind in ("decision_tree", "random_forest")
        common: dict[str, Any] = dict(
            featuresCol=VECTOR, labelCol="label", predictionCol="_prediction", maxDepth=self.max_depth,
            minInstancesPerNode=self.min_leaf, maxBins=self.max_bins, seed=self.seed, maxMemoryInMB=1024,
            cacheNodeIds=deep, checkpointInterval=10,
        )
        if self.kind == "decision_tree":
            return DecisionTreeRegressor(**common)
        common["featureSubsetStrategy"] = self.feature_subset
        if self.kind == "random_forest":
            return Grower(RandomForestRegressor(numTrees=self.num_trees, **common))
        return Grower(GBTRegressor(
            maxIter=self.num_trees, stepSize=self.learning_rate, subsamplingRate=self.subsample, **common
        ), self.fits_at_once)


def forest_baseline(features, num_trees: int = 100, max_depth: int = 10, holdout: float = 0.2) -> Tree:
    return Tree(
        features=features, kind="random_forest", num_trees=num_trees, max_depth=max_depth, min_leaf=1,
        feature_subset="all", impute="constant", holdout=holdout,
    )


def boosted_baseline(features, num_trees: int = 100, max_depth: int = 6, holdout: float = 0.2) -> Tree:
    return Tree(
        features=features, kind="boosted_colsample", num_trees=num_trees, max_depth=max_depth,
        impute="constant", holdout=holdout,
    )


_CLASSES = {c.__name__: c for c in (DecisionTreeRegressionModel, RandomForestRegressionModel, GBTRegressionModel)}


def load(spark: SparkSession, path: str, meta: dict) -> TreeModel:
    inputs = load_inputs(meta)
    fitted = _CLASSES[meta["class"]].load(f"{path}/fitted")
    if not isinstance(fitted, DecisionTreeRegressionModel):
        fitted.grown = read_trees(spark, f"{path}/fitted", summed(fitted))
    return TreeModel(
        name=meta["name"], config=meta["config"], feature_names=inputs.features, history=meta["history"],
        inputs=inputs, fitted=fitted,
    )
