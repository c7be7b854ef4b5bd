"""Stacked forecaster: a linear model over base predictions and the original features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from functools import partial, reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SEED
from ..operators.metrics import mae, rmse
from ..operators.prep import fold_column, train_val_split
from .base import Forecaster, Model, in_parallel, load_model, write_json
from .linear import Linear, LinearModel, baseline
from .tree import boosted_baseline
from .vector import VectorForecaster, VectorModel


def _predicted(df: DataFrame, bases: dict[str, VectorModel]) -> DataFrame:
    """Add one unclipped prediction column per base model."""
    return reduce(lambda d, kv: kv[1].raw(d, f"base_{kv[0]}"), bases.items(), df)


@dataclass
class StackedModel(Model):
    bases: dict[str, VectorModel] = field(default_factory=dict)
    meta: LinearModel = None

    def transform(self, df: DataFrame) -> DataFrame:
        kept = [c for c in df.columns if c != "prediction"]
        scored = self.meta.transform(_predicted(df.select(*kept), self.bases))
        return scored.select(*kept, "prediction")

    def importance(self) -> dict[str, float]:
        return self.meta.importance()

    def save(self, spark: SparkSession, path: str) -> None:
        for name, model in self.bases.items():
            model.save(spark, f"{path}/base_{name}")
        self.meta.save(spark, f"{path}/meta")
        about = {
            "family": "stacked", "name": self.name, "bases": list(self.bases), "config": self.config,
            "features": self.feature_names, "history": self.history,
        }
        write_json(spark, about, f"{path}/about")


@dataclass
class Stacked(Forecaster):
    """Base models learn on all but one fold and predict that fold; the meta model learns from those.

    Folds come from the row keys, so the result does not depend on partitioning.
    """

    features: Sequence[str]
    bases: dict[str, VectorForecaster] | None = None
    target: str = "sale_amount"
    folds: int = 5
    holdout: float = 0.2
    fill: float = 0.0
    seed: int = SEED
    parallelism: int = 4

    def __post_init__(self):
        if self.bases is None:
            self.bases = {"linear": baseline(self.features), "boosted": boosted_baseline(self.features)}

    def fit(self, df: DataFrame) -> StackedModel:
        features = list(self.features)
        rows = df.filter(F.col(self.target).isNotNull()).fillna(self.fill, subset=features)
        held = None
        if self.holdout:
            rows, held = train_val_split(rows, self.holdout, self.seed)
        at_once = min(self.parallelism, (self.folds + 1) * len(self.bases))
        plain = {
            n: replace(b, features=features, target=self.target, holdout=0.0, keep=False, train_score=False, fits_at_once=at_once)
            for n, b in self.bases.items()
        }
        rows = fold_column(rows, self.folds, self.seed, "_fold").select("_fold", *features, self.target)
        # Read once per fold and base model.
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # No fit depends on another: one per fold and base model, and the final ones (fold None).
            wanted = [(k, n) for k in (*range(self.folds), None) for n in plain]
            parts_of = {k: rows if k is None else rows.filter(F.col("_fold") != k) for k in (*range(self.folds), None)}
            models = dict(zip(wanted, in_parallel([partial(plain[n].fit, parts_of[k]) for k, n in wanted], self.parallelism)))
            unseen = reduce(DataFrame.unionByName, [
                _predicted(rows.filter(F.col("_fold") == k), {n: models[k, n] for n in plain}) for k in range(self.folds)
            ])
            columns = [f"base_{n}" for n in plain]
            meta = Linear(
                features=[*columns, *features], target=self.target, impute="constant", scaling=None
            ).fit(unseen)
            final = {n: models[None, n] for n in plain}
        finally:
            rows.unpersist()
        model = StackedModel(
            name="stacked", feature_names=features, bases=final, meta=meta,
            config={"folds": self.folds, "bases": list(plain)}, history={"train_r2": meta.history["train_r2"]},
        )
        if held is not None:
            y, p = F.col(self.target), F.col("prediction")
            score = model.transform(held).agg(mae(y, p).alias("mae"), rmse(y, p).alias("rmse")).first()
            model.history |= {"validation_mae": score["mae"], "validation_rmse": score["rmse"]}
        return model


def load(spark: SparkSession, path: str, meta: dict) -> StackedModel:
    bases = {n: load_model(spark, f"{path}/base_{n}") for n in meta["bases"]}
    return StackedModel(
        name=meta["name"], config=meta["config"], feature_names=meta["features"], history=meta["history"],
        bases=bases, meta=load_model(spark, f"{path}/meta"),
    )
