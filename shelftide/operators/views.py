"""Business views over the sales fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (
    count_when,
    exact_avg,
    exact_avg_when,
    exact_sum,
    exact_sum_when,
    flag,
    share,
    weekday_sunday0,
)


def _rainy() -> Column:
    return F.col("weather") == "rainy"


def _promo() -> Column:
    return F.col("promo_flag") == 1


def hourly_business(sales: DataFrame) -> DataFrame:
    """One row per sales row with calendar, promotion, weather and stock flags."""
    dow = weekday_sunday0("dt")
    y = F.col("sale_amount")
    return sales.select(
        "dt",
        F.hour("dt").cast("int").alias("hour_of_day"),
        dow.alias("day_of_week"),
        flag(dow.isin(0, 6)).alias("is_weekend"),
        F.month("dt").cast("int").alias("month"),
        "city_id", "store_id",
        "first_category_id", "second_category_id", "third_category_id", "product_id",
        y.cast("double").alias("sale_amount"),
        flag(y > 0).alias("sale_flag"),
        flag(y > 10).alias("high_sales_flag"),
        F.col("discount").cast("double").alias("discount"),
        flag(F.col("discount") > 0).alias("promo_flag"),
        "holiday_flag", "activity_flag",
        F.when(F.col("precpt") > 0, "rainy").otherwise("clear").alias("weather"),
        "precpt", "avg_temperature", "avg_humidity", "avg_wind_level",
        flag((y == 0) & (F.col("activity_flag") == 1)).alias("stockout_flag"),
        # Shelf reading, as opposed to the flag inferred from sales above.
        flag(F.col("hours_stock_status") == 0).alias("stock_status_flag"),
    )


def store_dashboard(hb: DataFrame) -> DataFrame:
    y = "sale_amount"
    return hb.groupBy("city_id", "store_id").agg(
        F.count_distinct("dt").alias("total_days_recorded"),
        F.count(F.lit(1)).alias("total_hours_recorded"),
        exact_sum(y).alias("total_sales"),
        F.sum("sale_flag").alias("hours_with_sales"),
        F.sum("high_sales_flag").alias("hours_with_high_sales"),
        exact_avg(y).alias("avg_sales_per_hour"),
        F.sum("stockout_flag").alias("total_stockout_hours"),
        share("sale_flag").alias("engagement_rate"),
        F.sum("promo_flag").alias("promo_hours"),
        exact_avg_when(_promo(), y).alias("avg_sales_during_promo"),
        count_when(_rainy()).alias("rainy_hours"),
        exact_avg_when(_rainy(), y).alias("avg_sales_rainy_hours"),
    )


def category_intelligence(hb: DataFrame) -> DataFrame:
    y = "sale_amount"
    stockout = F.col("stockout_flag") == 1
    std = F.stddev_samp(y)
    return hb.groupBy("first_category_id").agg(
        F.count_distinct("store_id").alias("stores_count"),
        exact_sum(y).alias("total_sales"),
        exact_avg(y).alias("avg_sales_per_record"),
        exact_avg_when(F.col("sale_flag") == 1, y).alias("avg_sales_when_sold"),
        F.round(std, 6).alias("sales_stddev"),
        count_when(stockout).alias("total_stockout_hours"),
        exact_sum_when(stockout, y).alias("potential_lost_sales"),
        exact_sum_when(_promo(), y).alias("promo_sales"),
        exact_sum_when(_rainy(), y).alias("rainy_day_sales"),
        exact_sum_when(F.col("holiday_flag") == 1, y).alias("holiday_sales"),
        F.round(exact_avg(y) / F.nullif(std, F.lit(0.0)), 6).alias("consistency_index"),
    )


def rhythm_patterns(hb: DataFrame) -> DataFrame:
    y = F.col("sale_amount")
    avg = exact_avg(y)
    return hb.groupBy("day_of_week", "month").agg(
        avg.alias("avg_sales"),
        share("sale_flag").alias("activity_rate"),
        F.sum("high_sales_flag").alias("high_sales_hours"),
        F.sum("stockout_flag").alias("total_stockout_hours"),
        share("stockout_flag").alias("stockout_rate"),
        count_when(_rainy()).alias("rainy_hours"),
        count_when(_promo()).alias("promo_hours"),
        count_when(F.col("holiday_flag") == 1).alias("holiday_hours"),
        exact_avg(y + F.col("discount") * 10).alias("operational_pressure_index"),
        F.when(avg > 15, "High Activity")
        .when(avg.between(5, 15), "Medium Activity")
        .otherwise("Low Activity")
        .alias("activity_level"),
    )


def store_indicators(hb: DataFrame) -> DataFrame:
    """Ratios a regional manager compares stores by."""
    y = "sale_amount"
    # One row per store and product first: distinct products then cost nothing.
    per_product = hb.groupBy("store_id", "product_id").agg(
        F.sum(F.col(y).cast("decimal(18,4)")).alias("s"),
        F.sum(F.when(_promo(), F.col(y)).otherwise(0.0).cast("decimal(18,4)")).alias("ps"),
        F.count(F.lit(1)).alias("n"),
        F.sum("sale_flag").alias("active"),
        F.sum("stockout_flag").alias("stockouts"),
    )
    total = F.sum("s").cast("double")
    return per_product.groupBy("store_id").agg(
        F.sum("n").alias("total_hours"),
        F.count("product_id").alias("unique_products"),
        total.alias("total_sales"),
        (total / F.nullif(F.count("product_id"), F.lit(0))).alias("avg_sales_per_product"),
        (F.sum("stockouts") / F.sum("n")).alias("stockout_rate"),
        F.sum("active").alias("active_hours"),
        (total / F.nullif(F.sum("active"), F.lit(0))).alias("avg_sales_active_hour"),
        F.sum("ps").cast("double").alias("promo_sales"),
        (F.sum("ps").cast("double") / F.nullif(total, F.lit(0.0))).alias("promo_share"),
    )


VIEWS = {
    "hourly_business": hourly_business,
    "store_dashboard": store_dashboard,
    "category_intelligence": category_intelligence,
    "rhythm_patterns": rhythm_patterns,
}


def register_views(sales: DataFrame) -> None:
    """Register the fact table and the four views for ``spark.sql``."""
    sales.createOrReplaceTempView("raw_sales_data")
    hb = hourly_business(sales)
    hb.createOrReplaceTempView("hourly_business")
    for name in ("store_dashboard", "category_intelligence", "rhythm_patterns"):
        VIEWS[name](hb).createOrReplaceTempView(name)
