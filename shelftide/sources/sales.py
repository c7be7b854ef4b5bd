"""Readers and sampling for sales tables."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import SEED
from ..functions.columns import no_nan
from ..operators.prep import key_bucket
from ..schema import DAILY_SCHEMA, SALES_SCHEMA

log = logging.getLogger(__name__)


def clean(df: DataFrame) -> DataFrame:
    """Missing values are null only: NaN from floating columns becomes null."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: no_nan(c) for c in floats}) if floats else df


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType = SALES_SCHEMA) -> DataFrame:
    """Columns are found by their header, in any order; others are left out, and a missing one raises.

    Text that is no value of its column's type becomes null.
    """
    parts = []
    for one in [path] if isinstance(path, str) else path:
        text = spark.read.option("header", True).option("enforceSchema", False).csv(one)
        missing = [f.name for f in schema if f.name not in text.columns]
        if missing:
            raise ValueError(f"{one} has no column {', '.join(missing)}")
        parts.append(text.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema]))
    return clean(reduce(DataFrame.unionByName, parts))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return clean(parse_dt(spark.read.parquet(path)))


def read_train_eval(
    spark: SparkSession, train_path: str, eval_path: str, fraction: float = 1.0, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Training and evaluation tables, optionally a sample of whole series."""
    try:
        parts = [read_csv(spark, p) if str(p).endswith(".csv") else read_parquet(spark, p) for p in (train_path, eval_path)]
    except Exception:
        log.error("could not read %s and %s", train_path, eval_path)
        raise
    if fraction < 1.0:
        parts = [sample_series(p, fraction, seed) for p in parts]
    return parts[0], parts[1]


def parse_dt(df: DataFrame, dt: str = "dt") -> DataFrame:
    """Datetime column as TIMESTAMP; text that is no datetime becomes null."""
    kind = df.schema[dt].dataType
    if isinstance(kind, T.TimestampType):
        return df
    parsed = F.try_to_timestamp(F.col(dt)) if isinstance(kind, T.StringType) else F.col(dt).cast("timestamp")
    return df.withColumn(dt, parsed)


def explode_hours(
    daily: DataFrame, sales: str = "hours_sale", stock: str = "hours_stock_status", dt: str = "dt"
) -> DataFrame:
    """One row per hour from a table whose hourly measures are arrays per day."""
    pairs = F.arrays_zip(F.col(sales).alias("y"), F.col(stock).alias("s"))
    long = daily.select("*", F.posexplode(pairs).alias("_hour", "_v"))
    hourly = long.withColumns({
        dt: F.timestamp_add("HOUR", F.col("_hour"), F.date_trunc("day", F.col(dt))),
        "sale_amount": F.col("_v.y"),
        stock: F.col("_v.s"),
    })
    return hourly.select(*[f.name for f in SALES_SCHEMA])


def read_daily(spark: SparkSession, path: str, schema: T.StructType = DAILY_SCHEMA) -> DataFrame:
    return clean(explode_hours(spark.read.schema(schema).parquet(path)))


def repeated_hours(df: DataFrame) -> DataFrame:
    """Series and hours that occur more than once."""
    return (
        df.groupBy("store_id", "product_id", "dt").agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)
    )


def merge_repeated(df: DataFrame) -> DataFrame:
    """One row per series and hour: sales add up, other columns keep their largest value."""
    keys = ["store_id", "product_id", "dt"]
    rest = [c for c in df.columns if c not in (*keys, "sale_amount")]
    merged = df.groupBy(*keys).agg(F.sum("sale_amount").alias("sale_amount"), *[F.max(c).alias(c) for c in rest])
    return merged.select(*df.columns)


def sample_fraction(df: DataFrame, fraction: float, seed: int = SEED) -> DataFrame:
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def sample_series(
    df: DataFrame, fraction: float, seed: int = SEED, keys: Sequence[str] = ("store_id", "product_id")
) -> DataFrame:
    """A share of the series, each with all its rows, so lags stay intact."""
    return df.filter(key_bucket(list(keys), 1000, seed) < round(fraction * 1000))


def sample_n(
    df: DataFrame, n: int, keys: Sequence[str], seed: int = SEED, by: Column | None = None
) -> DataFrame:
    """At most ``n`` rows chosen by a hash of their keys; the same rows on every run."""
    chance = F.xxhash64(*keys, F.lit(seed)) if by is None else by
    return df.orderBy(chance, *keys).limit(n)


def sort_series(df: DataFrame, keys: Sequence[str] = ("store_id", "product_id", "dt")) -> DataFrame:
    """Rows ordered by series and time inside each partition of the series' range.

    The range takes the time as well, so a long series spreads over partitions.
    """
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def preview(df: DataFrame, n: int = 5, keys: Sequence[str] = ("store_id", "product_id", "dt")) -> DataFrame:
    return df.orderBy(*keys).limit(n)
