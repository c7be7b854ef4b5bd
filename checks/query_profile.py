"""Registered queries: sources, sinks, sampling and profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelftide.operators import prep, profile
from shelftide.sources import sales as source
from shelftide.sources import sinks

from . import inputs

ROW = ["store_id", "product_id", "dt"]


def _rounded(df, digits=6, nudge=None):
    """Doubles rounded for the comparison; ``nudge`` moves values off exact ties first."""
    kinds = dict(df.dtypes)
    return df.select(*[
        F.round(F.col(c) + nudge if nudge else c, digits).alias(c) if kinds[c] == "double" else F.col(c)
        for c in df.columns
    ])


def scan_sales(spark, sf_dir):
    """The table written as CSV, columns in another order and one more among them, and read back."""
    sales = inputs.sales(spark, sf_dir)
    path = inputs.folder(spark, "csv")
    sales.select(F.lit("x").alias("note"), *reversed(sales.columns)).write.option("header", True).csv(path)
    return source.read_csv(spark, path)


def parse_dt(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    text = events.select("event_id", F.col("ts").cast("string").alias("dt"))
    return source.parse_dt(text)


def write_predictions(spark, sf_dir):
    path = inputs.folder(spark, "predictions")
    sinks.write_predictions(inputs.predictions(spark, sf_dir), path)
    return spark.read.parquet(path)


def profile_duplicates(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return profile.duplicate_rows(lines)


def outlier_flag(spark, sf_dir):
    flagged = profile.outlier_flag(inputs.sales(spark, sf_dir))
    return _rounded(flagged.select(*ROW, "sale_zscore", "outlier_flag"))


def _on_sales(fn, rounded=False):
    def run(spark, sf_dir):
        out = fn(inputs.sales(spark, sf_dir))
        return _rounded(out) if rounded else out

    return run


QUERIES = {
    "scan_sales": scan_sales,
    "parse_dt": parse_dt,
    "sample_fraction": _on_sales(lambda d: source.sample_series(d, 0.3).select(*ROW)),
    "sample_n": _on_sales(
        lambda d: source.sample_n(d, 100, ROW, by=prep.key_bucket(prep.row_keys(), prep.MODULUS)).select(*ROW, "sale_amount")),
    "sort_series": _on_sales(lambda d: source.sort_series(d).select(*ROW, "sale_amount")),
    "preview": _on_sales(lambda d: source.preview(d, 5)),
    "write_predictions": write_predictions,
    "profile_shape": lambda spark, d: profile.shape(inputs.train(spark, d), inputs.evaluation(spark, d)),
    "profile_time_span": _on_sales(profile.time_span),
    "profile_dimensions": _on_sales(profile.dimensions),
    "profile_target": _on_sales(profile.target_summary),
    "profile_stockout": _on_sales(profile.stockout),
    "profile_nulls": lambda spark, d: profile.null_counts(inputs.labelled_documents(spark, d)),
    "profile_duplicates": profile_duplicates,
    "profile_summary": lambda spark, d: profile.data_summary(inputs.train(spark, d), inputs.evaluation(spark, d)),
    "describe": _on_sales(profile.describe, True),
    "target_moments": _on_sales(profile.target_moments, True),
    "zero_ratio": _on_sales(profile.zero_ratio),
    "sales_histogram": _on_sales(profile.histogram, True),
    "mean_by_hour": _on_sales(profile.mean_by_hour),
    "mean_by_dow": _on_sales(profile.mean_by_weekday),
    "hour_dow_pivot": _on_sales(profile.hour_weekday_matrix),
    "stockout_profile": _on_sales(profile.stockout_profile),
    "stockout_by_hour": _on_sales(profile.stockout_by_hour),
    "top_stores": _on_sales(profile.top_stores),
    "outlier_flag": outlier_flag,
    "validate_input": lambda spark, d: profile.validate_input(inputs.labelled_documents(spark, d), "quality"),
}
