"""Models that predict from a feature vector with Spark ML."""

from __future__ import annotations

import logging
from abc import abstractmethod
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import partial
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SEED
from ..operators.metrics import mae, r2, rmse
from ..operators.prep import fold_column, train_val_split
from ..operators.profile import validate_input
from .base import Forecaster, Model, in_parallel, write_json
from .inputs import VECTOR, Inputs, choose_features, fit_inputs

log = logging.getLogger(__name__)


@dataclass
class VectorModel(Model):
    """A Spark ML model with the preparation it was fitted on."""

    inputs: Inputs = None
    fitted: Any = None
    family: str = "linear"

    def raw(self, df: DataFrame, name: str) -> DataFrame:
        """Add the prediction as the model gives it, without clipping."""
        assembled = self.inputs.assemble(df)
        return self.fitted.transform(assembled).select(*df.columns, F.col("_prediction").alias(name))

    def transform(self, df: DataFrame) -> DataFrame:
        kept = [c for c in df.columns if c != "prediction"]
        out = self.raw(df.select(*kept), "_raw")
        return out.select(*kept, F.greatest(F.nanvl("_raw", F.lit(0.0)), F.lit(0.0)).alias("prediction"))

    def save(self, spark: SparkSession, path: str) -> None:
        self.fitted.write().overwrite().save(f"{path}/fitted")
        about = {
            "family": self.family, "name": self.name, "config": self.config, "inputs": self.inputs.record(),
            "history": self.history, "class": type(self.fitted).__name__,
        }
        write_json(spark, about, f"{path}/about")


@dataclass
class VectorForecaster(Forecaster):
    """Common fitting: choose features, prepare, fit, keep the training record."""

    features: Sequence[str] | None = None
    target: str = "sale_amount"
    impute: str = "median"
    scaling: str | None = None
    seed: int = SEED
    check: bool = False
    # Share of rows held back to report the error on; 0 fits on all rows.
    holdout: float = 0.0
    # Keep the feature columns while fitting: several passes read them, and the
    # windows behind them cost more than their storage.
    keep: bool = True
    train_score: bool = True
    # Other fits that run at the same time fill the cores, so each may keep to fewer tasks.
    fits_at_once: int = 1

    @abstractmethod
    def estimator(self, rows: DataFrame):
        """Spark ML estimator for the prepared rows."""

    @abstractmethod
    def model(self, **fields) -> VectorModel:
        """Fitted model of the family."""

    def label(self) -> str:
        return type(self).__name__

    def fit(self, df: DataFrame) -> VectorModel:
        features = choose_features(df, self.features, self.target)
        if self.check:
            validate_input(df.select(*features, self.target), self.target)
        rows = df.filter(F.col(self.target).isNotNull())
        held = None
        if self.holdout:
            rows, held = train_val_split(rows, self.holdout, self.seed)
        rows = rows.select(*features, self.target)
        if self.keep:
            rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            inputs = fit_inputs(rows, features, self.impute, self.scaling)
            label = F.col(self.target).cast("double").alias("label")
            prepared = inputs.assemble(rows).select(VECTOR, label)
            fitted = self.estimator(prepared).fit(prepared)
            model = self.model(
                name=self.label(), config=self.settings(), feature_names=features, inputs=inputs, fitted=fitted,
                history={"n_features": len(features)},
            )
            if self.train_score:
                scored = model.raw(rows, "_raw")
                model.history["train_r2"] = r2(scored, self.target, "_raw").first()[0]
        finally:
            if self.keep:
                rows.unpersist()
        if held is not None:
            y, p = F.col(self.target), F.col("prediction")
            score = model.transform(held).agg(mae(y, p).alias("mae"), rmse(y, p).alias("rmse")).first()
            model.history |= {"validation_mae": score["mae"], "validation_rmse": score["rmse"]}
            log.info("%s: validation MAE %s, RMSE %s", model.name, score["mae"], score["rmse"])
        return model

    def settings(self) -> dict[str, Any]:
        return {k: (list(v) if isinstance(v, tuple) else v) for k, v in vars(self).items()}

    def cross_validate(self, df: DataFrame, folds: int = 5, parallelism: int = 4) -> DataFrame:
        """MAE per fold, unclipped; folds come from the row keys."""
        spark = df.sparkSession
        features = choose_features(df, self.features, self.target)
        plain = replace(self, features=features, holdout=0.0, check=False, keep=False, train_score=False)
        rows = fold_column(df.filter(F.col(self.target).isNotNull()), folds, self.seed, "_fold")
        rows = rows.select("_fold", *features, self.target).persist(StorageLevel.MEMORY_AND_DISK)

        def score(k: int) -> tuple[int, float]:
            model = plain.fit(rows.filter(F.col("_fold") != k))
            scored = model.raw(rows.filter(F.col("_fold") == k), "_raw")
            return k, scored.agg(mae(F.col(self.target), F.col("_raw"))).first()[0]

        try:
            scores = in_parallel([partial(score, k) for k in range(folds)], parallelism)
        finally:
            rows.unpersist()
        return spark.createDataFrame(scores, "fold int, mae double")


def cross_validation_summary(scores: DataFrame) -> DataFrame:
    return scores.agg(F.avg("mae").alias("mean_mae"), F.stddev_pop("mae").alias("std_mae"))


def load_inputs(meta: dict) -> Inputs:
    return Inputs(**meta["inputs"])
