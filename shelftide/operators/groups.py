"""Statistics per store, product, category or city, joined back to the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import STAGE_BINS
from ..functions.columns import binned, exact_avg, exact_sum
from .series import attach, distinct_keys

Y = "sale_amount"


def _cents(c: Column) -> Column:
    """Two digits, ties to even."""
    return F.bround(c, 2)


def store_table(df: DataFrame) -> DataFrame:
    return df.groupBy("store_id").agg(
        _cents(exact_avg(Y)).alias("store_avg_sales"),
        _cents(F.stddev_samp(Y)).alias("store_sales_volatility"),
        _cents(F.max(Y)).alias("store_max_sales"),
        F.count_distinct("product_id").alias("store_product_count"),
    )


def product_table(df: DataFrame) -> DataFrame:
    return df.groupBy("product_id").agg(
        _cents(exact_avg(Y)).alias("product_avg_sales"),
        _cents(F.stddev_samp(Y)).alias("product_sales_volatility"),
        F.count_distinct("store_id").alias("product_store_count"),
    )


def city_table(df: DataFrame) -> DataFrame:
    return df.groupBy("city_id").agg(
        _cents(exact_avg(Y)).alias("city_avg_sales"),
        _cents(exact_avg("hours_stock_status")).alias("city_stock_availability"),
    )


def _attach_one(df: DataFrame, stats: DataFrame, *keys: str, spread: bool = False) -> DataFrame:
    return attach(df, stats, keys, distinct_keys(df, keys)[0], spread=spread)


def store_stats(df: DataFrame) -> DataFrame:
    return _attach_one(df, store_table(df), "store_id")


def product_stats(df: DataFrame) -> DataFrame:
    return _attach_one(df, product_table(df), "product_id")


def city_stats(df: DataFrame) -> DataFrame:
    return _attach_one(df, city_table(df), "city_id")


def categorical_features(df: DataFrame) -> DataFrame:
    """Store, product and city statistics together."""
    n_store, n_product, n_city = distinct_keys(df, ["store_id"], ["product_id"], ["city_id"])
    out = attach(df, store_table(df), ["store_id"], n_store)
    out = attach(out, product_table(df), ["product_id"], n_product)
    return attach(out, city_table(df), ["city_id"], n_city)


def store_feature_columns() -> list[Column]:
    return [
        exact_sum(Y).alias("store_total_sales"),
        F.count_distinct("product_id").alias("store_num_products"),
        exact_avg(Y).alias("store_avg_sales_per_product"),
        (F.count(F.when(F.col("hours_stock_status") == 0, 1)) / F.count(F.lit(1))).alias("store_stockout_freq"),
    ]


def store_features(df: DataFrame) -> DataFrame:
    return _attach_one(df, df.groupBy("store_id").agg(*store_feature_columns()), "store_id")


def avg_discount(df: DataFrame, category: str = "first_category_id", discount: str = "discount") -> DataFrame:
    n_store, n_category = distinct_keys(df, ["store_id"], [category])
    by_store = df.groupBy("store_id").agg(exact_avg(discount).alias("avg_discount_store"))
    by_category = df.groupBy(category).agg(exact_avg(discount).alias("avg_discount_category"))
    return attach(attach(df, by_store, ["store_id"], n_store), by_category, [category], n_category)


def product_stage(df: DataFrame, bins=STAGE_BINS) -> DataFrame:
    stages = df.groupBy("product_id").agg(binned(exact_avg(Y), bins).alias("product_stage"))
    return _attach_one(df, stages, "product_id")


def category_spillover(df: DataFrame, category: str = "first_category_id") -> DataFrame:
    totals = df.groupBy(category).agg(exact_sum(Y).alias("category_sales_sum"))
    return _attach_one(df, totals, category)


def complementary_count(df: DataFrame) -> DataFrame:
    """Other products the store has in the same hour."""
    # A cell holds the products of one store in one hour, so its set is small and no join is needed.
    cell = F.size(F.collect_set("product_id").over(Window.partitionBy("store_id", "dt")))
    return df.withColumn("comp_products_count", (cell - 1).cast("long"))


def city_total(df: DataFrame, city: str = "city_id") -> DataFrame:
    totals = df.groupBy(city).agg(exact_sum(Y).alias("city_total_sales"))
    return _attach_one(df, totals, city)
