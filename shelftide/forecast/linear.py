"""Linear forecasters: least squares, ridge, lasso, elastic net.

Penalties follow the usual definitions: ridge minimises |y - Xw|^2 + alpha |w|^2,
lasso and elastic net |y - Xw|^2 / 2n + alpha (l |w| + (1 - l) |w|^2 / 2).
Spark scales the penalty by the spread of the label; the settings below undo that.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .inputs import VECTOR
from .vector import VectorForecaster, VectorModel, load_inputs

KINDS = ("linear", "ridge", "lasso", "elasticnet")


@dataclass
class LinearModel(VectorModel):
    family: str = "linear"

    def coefficients(self) -> dict[str, float]:
        """Coefficient per feature, in units of the prepared feature, and the intercept."""
        out = dict(zip(self.feature_names, (float(v) for v in self.fitted.coefficients)))
        return {**out, "intercept": float(self.fitted.intercept)}

    def coefficient_rows(self, spark: SparkSession) -> DataFrame:
        rows = [(k, v, None if k == "intercept" else abs(v)) for k, v in self.coefficients().items()]
        return spark.createDataFrame(rows, "feature string, coefficient double, importance double")

    def importance(self) -> dict[str, float]:
        return {k: abs(v) for k, v in self.coefficients().items() if k != "intercept"}


@dataclass
class Linear(VectorForecaster):
    kind: str = "linear"
    alpha: float = 1.0
    l1_ratio: float = 0.5
    max_iter: int = 1000
    scaling: str | None = "standard"

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown kind: {self.kind}, choose from {KINDS}")

    def label(self) -> str:
        return f"linear_{self.kind}"

    def model(self, **fields) -> LinearModel:
        return LinearModel(**fields)

    def estimator(self, rows: DataFrame) -> LinearRegression:
        penalty, mix = 0.0, 0.0
        if self.kind != "linear":
            stats = rows.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("label").alias("spread")).first()
            n, spread = stats["n"], stats["spread"] or 0.0
            if self.kind == "ridge":
                penalty = self.alpha * spread / n
            elif self.kind == "lasso":
                penalty, mix = self.alpha, 1.0
            else:
                l1, l2 = self.alpha * self.l1_ratio, self.alpha * (1 - self.l1_ratio) * spread
                penalty = l1 + l2
                mix = l1 / penalty if penalty else 0.0
        return LinearRegression(
            featuresCol=VECTOR, labelCol="label", predictionCol="_prediction", solver="normal",
            regParam=penalty, elasticNetParam=mix, standardization=False, maxIter=self.max_iter, tol=1e-9,
        )


def baseline(features, kind: str = "ridge", alpha: float = 1.0, scaler: bool = True, holdout: float = 0.2) -> Linear:
    """Ridge on zero-filled, scaled features, scored on held-back rows."""
    return Linear(
        features=features, kind=kind, alpha=alpha, impute="constant",
        scaling="standard" if scaler else None, holdout=holdout,
    )


def load(spark: SparkSession, path: str, meta: dict) -> LinearModel:
    inputs = load_inputs(meta)
    return LinearModel(
        name=meta["name"], config=meta["config"], feature_names=inputs.features, history=meta["history"],
        inputs=inputs, fitted=LinearRegressionModel.load(f"{path}/fitted"),
    )
