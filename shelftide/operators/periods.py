"""Rows inside periods of a calendar, such as school holidays by city.

Overlapping periods of a place are merged first, so a row lies in one at most. Periods are spread over buckets of time, and
rows meet only those of their place and bucket: a hash join with a range condition, never a nested loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import TARGET
from ..functions.columns import exact_avg, flag
from .series import BROADCAST_KEYS

BUCKET_DAYS = 30
_BUCKET = BUCKET_DAYS * 86_400


def merged_periods(periods: DataFrame, place: str = "city_id") -> DataFrame:
    """``periods`` (place, ``start``, ``end``, both included) without overlaps; periods that touch become one.

    Rows with a null place or end, or that end before they start, are no periods.
    """
    known = periods.filter(F.col(place).isNotNull() & (F.col("start") <= F.col("end"))).select(
        place, F.col("start").cast("timestamp").alias("start"), F.col("end").cast("timestamp").alias("end"))
    along = Window.partitionBy(place).orderBy("start", "end")
    reached = F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    begins = flag(reached.isNull() | (F.col("start") > reached))
    numbered = known.withColumn("_begins", begins).withColumn("_number", F.sum("_begins").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(place, "_number").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_number")


def in_periods(df: DataFrame, periods: DataFrame, place: str = "city_id", time: str = "dt", prefix: str = "school") -> DataFrame:
    """``df`` with ``<prefix>_break`` (0 or 1), and hours since the break began and until it ends (null outside)."""
    bucket = lambda c: F.floor(F.unix_seconds(F.col(c).cast("timestamp")) / _BUCKET)
    whole = merged_periods(periods, place)
    spread = whole.select(
        F.col(place).alias("_place"), F.col("start").alias("_start"), F.col("end").alias("_end"), F.explode(F.sequence(bucket("start"), bucket("end"))).alias("_slot"))
    if spread.count() <= BROADCAST_KEYS:
        spread = F.broadcast(spread)
    rows = df.withColumn("_bucket", bucket(time))
    hit = (F.col(place) == F.col("_place")) & (F.col("_bucket") == F.col("_slot")) & (F.col(time) >= F.col("_start")) & (F.col(time) <= F.col("_end"))
    hours = lambda a, b: (F.unix_seconds(F.col(b).cast("timestamp")) - F.unix_seconds(F.col(a).cast("timestamp"))) / F.lit(3600.0)
    return rows.join(spread, hit, "left").select(
        *df.columns, flag(F.col("_start").isNotNull()).alias(f"{prefix}_break"),
        hours("_start", time).alias(f"{prefix}_hours_since"), hours(time, "_end").alias(f"{prefix}_hours_left"))


def period_effect(flagged: DataFrame, place: str = "city_id", y: str = TARGET, prefix: str = "school") -> DataFrame:
    """Per place the mean of ``y`` inside and outside of breaks and their difference."""
    inside = F.col(f"{prefix}_break") == 1
    means = flagged.groupBy(place).agg(
        F.count_if(inside).alias("n_break"), exact_avg(F.when(inside, F.col(y))).alias("mean_break"), exact_avg(F.when(~inside, F.col(y))).alias("mean_rest"))
    return means.withColumn("effect", F.col("mean_break") - F.col("mean_rest"))
