"""Forecaster protocol: ``fit(df)`` gives a model, ``model.transform(df)`` adds ``prediction``."""

from __future__ import annotations

import json
from abc import ABC, abstractmethod
from collections.abc import Callable
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SERIES = ["store_id", "product_id"]


def require(df: DataFrame, columns: list[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def write_json(spark: SparkSession, record: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(record, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str) -> dict:
    try:
        return json.loads(spark.read.text(path).first()[0])
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(f"no model at {path}") from e
        raise


@dataclass
class Model(ABC):
    """A fitted forecaster."""

    name: str
    config: dict[str, Any] = field(default_factory=dict)
    feature_names: list[str] = field(default_factory=list)
    history: dict[str, Any] = field(default_factory=dict)

    @abstractmethod
    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``prediction``."""

    @abstractmethod
    def save(self, spark: SparkSession, path: str) -> None:
        """Write the model under ``path``."""

    def importance(self) -> dict[str, float] | None:
        """Importance per feature, where the model has one."""
        return None

    def summary(self) -> dict[str, Any]:
        return {
            "model_name": self.name,
            "is_fitted": True,
            "num_features": len(self.feature_names) or None,
            "config": self.config,
            "training_history": self.history,
        }


class Forecaster(ABC):
    """An unfitted forecaster."""

    @abstractmethod
    def fit(self, df: DataFrame) -> Model:
        """Fit on training rows."""

    def save(self, spark: SparkSession, path: str) -> None:
        raise ValueError("cannot save a forecaster before fit")

    def transform(self, df: DataFrame) -> DataFrame:
        raise ValueError("fit the forecaster before predicting")

    def summary(self) -> dict[str, Any]:
        return {
            "model_name": type(self).__name__, "is_fitted": False, "num_features": None,
            "config": dict(vars(self)), "training_history": {},
        }


def in_parallel(jobs: list[Callable[[], Any]], parallelism: int) -> list[Any]:
    """Results of independent fits, up to ``parallelism`` at a time."""
    with ThreadPool(max(1, min(parallelism, len(jobs)))) as pool:
        return pool.map(lambda job: job(), [inheritable_thread_target(job) for job in jobs])


def importance_rows(spark: SparkSession, importance: dict[str, float], top: int | None = None) -> DataFrame:
    """Importances as rows, largest first; one row per feature."""
    rows = spark.createDataFrame(list(importance.items()), "feature string, importance double")
    rows = rows.orderBy(F.desc("importance"), "feature")
    return rows.limit(top) if top else rows


def load_model(spark: SparkSession, path: str) -> Model:
    """Load any saved model."""
    from . import linear, naive, stack, tree

    meta = read_json(spark, f"{path}/about")
    loaders = {
        "naive": naive.load, "linear": linear.load, "tree": tree.load, "stacked": stack.load,
    }
    return loaders[meta["family"]](spark, path, meta)
