"""Schema of the sales fact table: one row per store, product and hour."""

from __future__ import annotations

from pyspark.sql import types as T

_LONGS = (
    "city_id", "store_id", "product_id",
    "first_category_id", "second_category_id", "third_category_id",
)
_WEATHER = ("precpt", "avg_temperature", "avg_humidity", "avg_wind_level")

SALES_SCHEMA = T.StructType(
    [T.StructField(c, T.LongType()) for c in _LONGS]
    + [
        T.StructField("dt", T.TimestampType()),
        T.StructField("sale_amount", T.DoubleType()),
        T.StructField("hours_stock_status", T.IntegerType()),
        T.StructField("discount", T.DoubleType()),
        T.StructField("holiday_flag", T.IntegerType()),
        T.StructField("activity_flag", T.IntegerType()),
    ]
    + [T.StructField(c, T.DoubleType()) for c in _WEATHER]
)

# Daily layout: the hourly measures of one day are 24-element arrays.
DAILY_SCHEMA = T.StructType(
    [T.StructField(c, T.LongType()) for c in _LONGS]
    + [
        T.StructField("dt", T.TimestampType()),
        T.StructField("hours_sale", T.ArrayType(T.DoubleType())),
        T.StructField("hours_stock_status", T.ArrayType(T.IntegerType())),
        T.StructField("discount", T.DoubleType()),
        T.StructField("holiday_flag", T.IntegerType()),
        T.StructField("activity_flag", T.IntegerType()),
    ]
    + [T.StructField(c, T.DoubleType()) for c in _WEATHER]
)


def numeric_columns(schema: T.StructType, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]
