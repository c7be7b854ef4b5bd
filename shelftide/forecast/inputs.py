"""Fitted preparation of a feature vector: fill, scale, assemble."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.prep import medians, numeric_columns, scale_parameters

VECTOR = "_features"
NOT_FEATURES = ("store_id", "product_id", "city_id", "dt", "sale_amount")


@dataclass
class Inputs:
    """Two or three numbers per feature, learned on the training rows."""

    features: list[str]
    fill: dict[str, float] = field(default_factory=dict)
    centre: dict[str, float] = field(default_factory=dict)
    scale: dict[str, float] = field(default_factory=dict)

    def column(self, c: str, floating: bool = True) -> Column:
        """Prepared feature. Kept short, so that wide feature sets stay in compiled code."""
        value = F.col(c).cast("double")
        known = F.nanvl(value, F.lit(None).cast("double")) if floating else value
        out = F.coalesce(known, F.lit(self.fill.get(c, 0.0)))
        if self.scale:
            # An infinite value becomes a large finite one; finite ones stay as they are.
            out = (out - F.lit(self.centre[c])) * F.lit(1.0 / self.scale[c])
            if floating:
                out = F.when(out == math.inf, F.lit(1e10)).when(out == -math.inf, F.lit(-1e10)).otherwise(out)
        return out

    def columns(self, df: DataFrame) -> list[Column]:
        floating = {f.name for f in df.schema if f.dataType.typeName() in ("double", "float")}
        return [self.column(c, c in floating) for c in self.features]

    def assemble(self, df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
        names = [f"_f{i}" for i in range(len(self.features))]
        wide = df.withColumns(dict(zip(names, self.columns(df))))
        return VectorAssembler(inputCols=[*names, *extra], outputCol=VECTOR).transform(wide).drop(*names)

    def record(self) -> dict:
        return {"features": self.features, "fill": self.fill, "centre": self.centre, "scale": self.scale}


def fit_inputs(df: DataFrame, features: Sequence[str], impute: str, scaling: str | None) -> Inputs:
    features = list(features)
    inputs = Inputs(features)
    if impute == "median":
        row = medians(df, features).first()
        inputs.fill = {c: 0.0 if row[c] is None else float(row[c]) for c in features}
    elif impute == "constant":
        inputs.fill = dict.fromkeys(features, 0.0)
    else:
        raise ValueError(f"unknown imputation: {impute}")
    if scaling:
        filled = df.select(*[v.alias(c) for c, v in zip(features, inputs.columns(df))])
        row = scale_parameters(filled, features, scaling).first()
        inputs.centre = {c: float(row[f"{c}_centre"]) for c in features}
        inputs.scale = {c: float(row[f"{c}_scale"]) for c in features}
    return inputs


def choose_features(df: DataFrame, features: Sequence[str] | None, target: str) -> list[str]:
    if features:
        missing = [c for c in features if c not in df.columns]
        if missing:
            raise ValueError(f"missing columns: {missing}")
        kinds = df.select(*features)
        return numeric_columns(kinds)
    return numeric_columns(df, exclude=[*NOT_FEATURES, target])
