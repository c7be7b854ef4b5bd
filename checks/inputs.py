"""Inputs the registered queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelftide.operators.views import hourly_business
from shelftide.sources.retail import eval_part, retail_hourly, train_part

_kept: dict[tuple[str, str], DataFrame] = {}


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _kept:
        _kept[key] = retail_hourly(spark, sf_dir).persist()
    return _kept[key]


def hb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_business(sales(spark, sf_dir))


def train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train_part(sales(spark, sf_dir))


def evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eval_part(sales(spark, sf_dir))


def seen_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows without one series, so that predicting it takes the default."""
    from pyspark.sql import functions as F

    return train(spark, sf_dir).filter(~((F.col("store_id") == 0) & (F.col("product_id") == 11)))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation rows with the value of the same hour a week earlier, hour and product volume."""
    from pyspark.sql import functions as F

    from shelftide.forecast.naive import SeasonalNaive
    from shelftide.functions.columns import exact_sum
    from shelftide.operators.series import attach, distinct_keys

    past, future = train(spark, sf_dir), evaluation(spark, sf_dir)
    volume = past.groupBy("product_id").agg(exact_sum("sale_amount").alias("product_volume"))
    scored = SeasonalNaive().fit(past).transform(future).withColumn("hour", F.hour("dt").cast("int"))
    return attach(scored, volume, ["product_id"], distinct_keys(past, ["product_id"])[0])


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return docs.join(labels, "doc_id", "left")


def folder(spark: SparkSession, name: str) -> str:
    """A new folder on the storage the session shares with its executors."""
    import uuid

    from shelftide.session import checkpoint_folder

    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"
