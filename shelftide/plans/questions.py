"""Thirty business questions as DataFrame plans.

``sales`` is the fact table, ``hb`` the ``hourly_business`` view. Every top-k has
a unique tiebreak, and null scores sort last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (
    MONEY,
    count_when,
    exact_avg,
    exact_avg_when,
    exact_sum,
    exact_sum_when,
    share,
    weekday_sunday0,
)
from ..operators.views import store_dashboard

Y = "sale_amount"
HOURS_PER_ROW = 24


def _top(df: DataFrame, n: int, by: str, *tiebreak: str) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(by), *tiebreak).limit(n)


def _stockout_pct(column: str = "stockout_flag") -> Column:
    return F.lit(100.0) * F.sum(column) / F.count(F.lit(1))


# --- shape of the data -------------------------------------------------------

def store_city_counts(sales: DataFrame) -> DataFrame:
    pairs = sales.select("store_id", "city_id").distinct()
    return pairs.agg(
        F.count_distinct("store_id").alias("unique_stores"),
        F.count_distinct("city_id").alias("unique_cities"),
    )


def date_range(sales: DataFrame) -> DataFrame:
    return sales.agg(F.min("dt").alias("start_date"), F.max("dt").alias("end_date"))


def product_counts(sales: DataFrame) -> DataFrame:
    cols = ["product_id", "first_category_id", "second_category_id", "third_category_id"]
    names = ["unique_products", "first_categories", "second_categories", "third_categories"]
    # The distinct combinations are few, so the four counts never see the fact rows.
    combos = sales.select(*cols).distinct()
    return combos.agg(*[F.count_distinct(c).alias(n) for c, n in zip(cols, names)])


def total_sales(sales: DataFrame) -> DataFrame:
    return sales.agg(exact_sum(Y).alias("total_sales"))


def avg_per_hour(sales: DataFrame, hours_per_row: int = HOURS_PER_ROW) -> DataFrame:
    return sales.agg((exact_sum(Y) / (F.count(F.lit(1)) * F.lit(hours_per_row))).alias("avg_sales_per_hour"))


def zero_nonzero(sales: DataFrame) -> DataFrame:
    return sales.agg(
        count_when(F.col(Y) == 0).alias("zero_sales_hours"),
        count_when(F.col(Y) > 0).alias("non_zero_sales_hours"),
    )


# --- time patterns and outside factors ---------------------------------------

def sales_by_hour(sales: DataFrame) -> DataFrame:
    out = sales.groupBy(F.hour("dt").cast("int").alias("hour_of_day")).agg(exact_sum(Y).alias("total_sales"))
    return out.orderBy(F.desc("total_sales"), "hour_of_day")


def sales_by_weekday(sales: DataFrame) -> DataFrame:
    out = sales.groupBy(weekday_sunday0("dt").alias("day_of_week")).agg(exact_sum(Y).alias("total_sales"))
    return out.orderBy(F.desc("total_sales"), "day_of_week")


def holiday_avg(sales: DataFrame) -> DataFrame:
    return sales.groupBy("holiday_flag").agg(exact_avg(Y).alias("avg_sales"))


def rain_avg(sales: DataFrame) -> DataFrame:
    weather = F.when(F.col("precpt") > 0, "rainy").otherwise("clear").alias("weather")
    return sales.groupBy(weather).agg(exact_avg(Y).alias("avg_sales"))


def weekend_promo_city(hb: DataFrame) -> DataFrame:
    out = hb.filter((F.col("is_weekend") == 1) & (F.col("promo_flag") == 1))
    out = out.groupBy("city_id").agg(exact_sum(Y).alias("total_sales"))
    return out.orderBy(F.desc("total_sales"), "city_id")


def dashboard_top(hb: DataFrame, n: int = 5) -> DataFrame:
    board = store_dashboard(hb).select("city_id", "store_id", "total_sales", "avg_sales_per_hour")
    return _top(board, n, "total_sales", "city_id", "store_id")


def dashboard_bottom(hb: DataFrame, n: int = 5) -> DataFrame:
    board = store_dashboard(hb).select("city_id", "store_id", "total_stockout_hours")
    return _top(board, n, "total_stockout_hours", "city_id", "store_id")


# --- inventory ---------------------------------------------------------------

def stockout_pct(hb: DataFrame) -> DataFrame:
    return hb.agg(_stockout_pct().alias("stockout_percentage"))


def stock_avg(hb: DataFrame, stock_flag: str = "stockout_flag") -> DataFrame:
    return hb.groupBy(stock_flag).agg(exact_avg(Y).alias("avg_sales"))


def worst_products(hb: DataFrame, n: int = 10) -> DataFrame:
    rates = hb.groupBy("product_id").agg(_stockout_pct().alias("stockout_rate_percentage"))
    return _top(rates, n, "stockout_rate_percentage", "product_id")


def stockout_by_hour(hb: DataFrame) -> DataFrame:
    rates = hb.groupBy("hour_of_day").agg(_stockout_pct().alias("stockout_rate_percentage"))
    return rates.orderBy("hour_of_day")


def worst_stores(hb: DataFrame, n: int = 5) -> DataFrame:
    rates = hb.groupBy("store_id").agg(_stockout_pct().alias("stockout_rate_percentage"))
    return _top(rates, n, "stockout_rate_percentage", "store_id")


# --- stores and products -----------------------------------------------------

def top_stores(hb: DataFrame, n: int = 10) -> DataFrame:
    totals = hb.groupBy("city_id", "store_id").agg(exact_sum(Y).alias("total_sales"))
    return _top(totals, n, "total_sales", "city_id", "store_id")


def city_avg_store(hb: DataFrame) -> DataFrame:
    stores = hb.groupBy("city_id", "store_id").agg(exact_sum(Y).alias("store_total"))
    out = stores.groupBy("city_id").agg(exact_avg("store_total").alias("avg_sales_per_store"))
    return out.orderBy(F.desc("avg_sales_per_store"), "city_id")


def high_sales_stockout(hb: DataFrame, min_sales: float = 1000.0, min_rate: float = 0.2) -> DataFrame:
    stores = hb.groupBy("city_id", "store_id").agg(
        exact_sum(Y).alias("total_sales"),
        _stockout_pct().alias("stockout_rate_percentage"),
        (F.sum("stockout_flag") / F.count(F.lit(1))).alias("rate"),
    )
    kept = stores.filter((F.col("total_sales") > min_sales) & (F.col("rate") > min_rate)).drop("rate")
    return kept.orderBy(F.desc("total_sales"), "city_id", "store_id")


def category_sales(hb: DataFrame) -> DataFrame:
    out = hb.groupBy("first_category_id").agg(exact_sum(Y).alias("total_sales"))
    return out.orderBy(F.desc("total_sales"), "first_category_id")


def product_avg(hb: DataFrame) -> DataFrame:
    out = hb.groupBy("product_id").agg(exact_avg(Y).alias("avg_hourly_sales"))
    return out.orderBy(F.desc_nulls_last("avg_hourly_sales"), "product_id")


# --- promotions --------------------------------------------------------------

def discount_avg(hb: DataFrame) -> DataFrame:
    kind = F.when(F.col("discount") > 0, "discounted").otherwise("regular").alias("price_type")
    return hb.groupBy(kind).agg(exact_avg(Y).alias("avg_sales"))


def discount_range() -> Column:
    """Discount band. Values between the bands, and null, belong to the last one."""
    d = F.col("discount")
    return (
        F.when(d == 0, "0%")
        .when(d.between(0.01, 0.10), "1-10%")
        .when(d.between(0.11, 0.20), "11-20%")
        .otherwise("21%+")
    )


def discount_ranges(hb: DataFrame) -> DataFrame:
    out = hb.groupBy(discount_range().alias("discount_range")).agg(exact_avg(Y).alias("avg_sales"))
    return out.orderBy(F.desc_nulls_last("avg_sales"), "discount_range")


def promo_lift(hb: DataFrame) -> DataFrame:
    promo = exact_avg_when(F.col("promo_flag") == 1, Y)
    regular = exact_avg_when(F.col("promo_flag") == 0, Y)
    out = hb.groupBy("first_category_id").agg(
        promo.alias("avg_sales_during_promo"),
        regular.alias("avg_sales_regular"),
        (promo - regular).alias("promo_lift"),
    )
    return out.orderBy(F.desc_nulls_last("promo_lift"), "first_category_id")


def activity_compare(hb: DataFrame) -> DataFrame:
    return hb.groupBy("activity_flag").agg(
        exact_avg(Y).alias("avg_sales"), exact_sum(Y).alias("total_sales"), F.count(F.lit(1)).alias("total_hours")
    )


def promo_stockout(hb: DataFrame, stock_flag: str = "stockout_flag") -> DataFrame:
    """Sales with and without promotion in hours that sold while out of stock.

    The flag inferred from sales rules such hours out, so it always gives no rows;
    ``stock_status_flag`` asks the same of the shelf reading.
    """
    hours = hb.filter((F.col("sale_flag") == 1) & (F.col(stock_flag) == 1))
    return hours.groupBy("promo_flag").agg(exact_avg(Y).alias("avg_sales"), F.count(F.lit(1)).alias("hours_count"))


# --- combined questions ------------------------------------------------------

def potential_pairs(hb: DataFrame, min_avg: float = 5.0, min_rate: float = 0.2, n: int = 20) -> DataFrame:
    pairs = hb.groupBy("store_id", "product_id").agg(
        exact_avg_when(F.col("stockout_flag") == 0, Y).alias("avg_sales_when_in_stock"),
        F.sum("stockout_flag").alias("stockout_hours"),
        F.count(F.lit(1)).alias("total_hours"),
        (F.sum("stockout_flag") / F.count(F.lit(1))).alias("stockout_rate"),
    )
    kept = pairs.filter((F.col("avg_sales_when_in_stock") > min_avg) & (F.col("stockout_rate") > min_rate))
    return kept.orderBy(
        F.desc("stockout_rate"), F.desc("avg_sales_when_in_stock"), "store_id", "product_id"
    ).limit(n)


def temperature_range() -> Column:
    """Temperature band. Values between the bands, and null, belong to the last one."""
    t = F.col("avg_temperature")
    return F.when(t < 10, "cold").when(t.between(10, 20), "mild").when(t.between(21, 30), "warm").otherwise("hot")


def weather_category(hb: DataFrame) -> DataFrame:
    out = hb.groupBy("first_category_id", temperature_range().alias("temp_range"), "weather").agg(
        exact_avg(Y).alias("avg_sales"), exact_sum(Y).alias("total_sales"), F.count(F.lit(1)).alias("hours_count")
    )
    return out.orderBy("first_category_id", "temp_range", "weather")


def peak_hours(hb: DataFrame, n: int = 3) -> DataFrame:
    hours = hb.groupBy("hour_of_day").agg(exact_sum(Y).alias("total_sales"))
    return _top(hours, n, "total_sales", "hour_of_day").select("hour_of_day")


def peak_stockouts(hb: DataFrame, peaks: int = 3, n: int = 10) -> DataFrame:
    """Products most often out of stock in the busiest hours.

    One pass reduces the fact table to hour x product; both the busiest hours and
    the stock-outs come from that. The broadcast side has ``peaks`` rows.
    """
    cells = hb.groupBy("hour_of_day", "product_id").agg(
        F.sum(F.col(Y).cast(MONEY)).alias("sales"), F.sum("stockout_flag").alias("stockouts")
    )
    hours = cells.groupBy("hour_of_day").agg(F.sum("sales").alias("sales"))
    busiest = hours.orderBy(F.desc_nulls_last("sales"), "hour_of_day").limit(peaks).select("hour_of_day")
    products = (
        cells.filter(F.col("stockouts") > 0)
        .join(F.broadcast(busiest), "hour_of_day")
        .groupBy("product_id")
        .agg(F.sum("stockouts").alias("stockout_hours"), F.sum("stockouts").alias("total_stockouts"))
    )
    return _top(products, n, "total_stockouts", "product_id")


def potential_increase(hb: DataFrame) -> DataFrame:
    """Sales if every stock-out hour had sold the product's in-stock average.

    Reduced to one row per product before the averages are applied: the fact rows
    are read once and are not joined to anything.
    """
    out_of_stock = F.col("stockout_flag") == 1
    products = (
        hb.filter(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(
            exact_sum(Y).alias("actual"),
            exact_sum_when(~out_of_stock, Y).alias("kept"),
            exact_avg_when(~out_of_stock, Y).alias("in_stock_avg"),
            F.sum("stockout_flag").alias("hours_out"),
        )
    )
    gained = F.coalesce(F.col("in_stock_avg") * F.col("hours_out"), F.lit(0.0))
    totals = products.agg(F.sum("actual").alias("actual"), F.sum(F.col("kept") + gained).alias("potential"))
    return totals.select(
        F.round("actual", 4).alias("actual_sales"),
        F.round("potential", 4).alias("potential_sales"),
        F.round(F.col("potential") - F.col("actual"), 4).alias("potential_increase"),
    )


def store_health(hb: DataFrame, n: int = 20) -> DataFrame:
    stores = hb.groupBy("store_id").agg(
        exact_sum(Y).alias("total_sales"),
        share("sale_flag").alias("engagement_rate"),
        (F.sum("stockout_flag") / F.count(F.lit(1))).alias("stockout_rate"),
        F.stddev_samp(Y).alias("std"),
    )
    score = (
        F.col("total_sales") * 0.5
        + F.col("engagement_rate") * 100 * 0.3
        - F.col("stockout_rate") * 100 * 0.1
        - F.col("std") * 0.1
    )
    scored = stores.select(
        "store_id", "total_sales", "engagement_rate", "stockout_rate",
        F.round("std", 6).alias("sales_stddev"),
        F.round(score, 6).alias("store_health_score"),
    )
    return _top(scored, n, "store_health_score", "store_id")


# Question key -> (plan, input it reads).
QUESTIONS = {
    "q01_store_city_counts": (store_city_counts, "sales"),
    "q02_date_range": (date_range, "sales"),
    "q03_product_counts": (product_counts, "sales"),
    "q04_total_sales": (total_sales, "sales"),
    "q05_avg_per_hour": (avg_per_hour, "sales"),
    "q06_zero_nonzero": (zero_nonzero, "sales"),
    "q07_sales_by_hour": (sales_by_hour, "sales"),
    "q08_sales_by_dow": (sales_by_weekday, "sales"),
    "q09_holiday_avg": (holiday_avg, "sales"),
    "q10_rain_avg": (rain_avg, "sales"),
    "weekend_promo_city": (weekend_promo_city, "hb"),
    "dashboard_top5": (dashboard_top, "hb"),
    "dashboard_bottom5": (dashboard_bottom, "hb"),
    "q11_stockout_pct": (stockout_pct, "hb"),
    "q12_stock_avg": (stock_avg, "hb"),
    "q13_worst_products": (worst_products, "hb"),
    "q14_stockout_by_hour": (stockout_by_hour, "hb"),
    "q15_worst_stores": (worst_stores, "hb"),
    "q16_top_stores": (top_stores, "hb"),
    "q17_city_avg_store": (city_avg_store, "hb"),
    "q18_high_sales_stockout": (high_sales_stockout, "hb"),
    "q19_category_sales": (category_sales, "hb"),
    "q20_product_avg": (product_avg, "hb"),
    "q21_discount_avg": (discount_avg, "hb"),
    "q22_discount_ranges": (discount_ranges, "hb"),
    "q23_promo_lift": (promo_lift, "hb"),
    "q24_activity_compare": (activity_compare, "hb"),
    "q25_promo_stockout": (promo_stockout, "hb"),
    "q26_potential_pairs": (potential_pairs, "hb"),
    "q27_weather_category": (weather_category, "hb"),
    "q28_peak_hours": (peak_hours, "hb"),
    "q28_peak_stockouts": (peak_stockouts, "hb"),
    "q29_potential_increase": (potential_increase, "hb"),
    "q30_store_health": (store_health, "hb"),
}
