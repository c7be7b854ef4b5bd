"""Hourly retail table derived from the ``events`` table.

Events are reduced to one row per store, product and hour on the map side
first. A calendar of the same hours is then generated for every store, and the
two are merged by key, so every series is gap-free.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import weekday_monday0

PRODUCTS = 12
USERS_PER_STORE = 15
SPLIT_AT = "2024-01-24 00:00:00"

# Size of a sale by weekday, Monday first.
WEEKDAY_FACTOR = (5, 20, 50, 100, 100, 100, 100)


def event_cells(events: DataFrame) -> DataFrame:
    """Cents sold and error flag per store, product and hour that has events."""
    is_error = F.col("event_type") == "error"
    return (
        events.select(
            F.floor(F.col("user_id") / USERS_PER_STORE).cast("long").alias("store_id"),
            (F.get_json_object("props", "$.k").cast("long") % PRODUCTS).alias("product_id"),
            F.date_trunc("hour", F.col("ts")).cast("timestamp").alias("dt"),
            F.when(is_error, 0).otherwise(F.round(F.col("value") * 100).cast("long")).alias("cents"),
            is_error.cast("int").alias("err"),
        )
        .groupBy("store_id", "product_id", "dt")
        .agg(F.sum("cents").alias("cents"), F.max("err").alias("err"))
    )


def retail_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    cells = event_cells(events)
    # Whole days from the first event to the last: two values.
    day = lambda c: F.date_trunc("day", c).cast("timestamp")
    first, last = events.agg(day(F.min("ts")), day(F.max("ts")) + F.expr("interval 23 hours")).first()
    hours = F.sequence(F.lit(first).cast("timestamp"), F.lit(last).cast("timestamp"), F.expr("interval 1 hour"))
    grid = (
        events.select(F.floor(F.col("user_id") / USERS_PER_STORE).cast("long").alias("store_id"))
        .distinct()
        .select("store_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PRODUCTS - 1).cast("long"))).alias("product_id"))
        .select("store_id", "product_id", F.explode(hours).alias("dt"))
    )
    day = F.dayofmonth("dt").cast("long")
    hour = F.hour("dt").cast("long")
    factor = F.element_at(F.array(*[F.lit(f) for f in WEEKDAY_FACTOR]), weekday_monday0("dt") + 1)
    product = F.col("product_id")
    return grid.join(cells, ["store_id", "product_id", "dt"], "left").select(
        (F.col("store_id") % 3).alias("city_id"),
        "store_id",
        "product_id",
        (product % 3).alias("first_category_id"),
        (product % 6).alias("second_category_id"),
        (product % 12).alias("third_category_id"),
        "dt",
        ((F.coalesce("cents", F.lit(0)) * 2 * (product + 1) * factor).cast("double") / 10000).alias("sale_amount"),
        F.when(F.col("err") == 1, 0).otherwise(1).alias("hours_stock_status"),
        (((product * 7 + day) % 8 * 4).cast("double") / 100).alias("discount"),
        day.isin(1, 15).cast("int").alias("holiday_flag"),
        ((product + day) % 3 == 0).cast("int").alias("activity_flag"),
        ((day % 5 * 3).cast("double") / 2).alias("precpt"),
        ((day * 7 % 32).cast("double") + hour.cast("double") / 4).alias("avg_temperature"),
        (40 + day % 7 * 5).cast("double").alias("avg_humidity"),
        ((1 + hour % 5).cast("double") / 2).alias("avg_wind_level"),
    )


def train_part(retail: DataFrame) -> DataFrame:
    return retail.filter(F.col("dt") < F.lit(SPLIT_AT).cast("timestamp"))


def eval_part(retail: DataFrame) -> DataFrame:
    return retail.filter(F.col("dt") >= F.lit(SPLIT_AT).cast("timestamp"))
