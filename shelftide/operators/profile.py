"""Profiling and data quality of a sales table."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import exact_avg, exact_avg_when, exact_sum, seconds, share, weekday_monday0
from ..schema import numeric_columns
from .quantiles import exact_percentiles, percentile_row

log = logging.getLogger(__name__)

SECONDS_PER_DAY = 86400


def shape(train: DataFrame, evaluation: DataFrame) -> DataFrame:
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("dataset"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
        )
        for name, df in (("train", train), ("eval", evaluation))
    ]
    return parts[0].unionByName(parts[1])


def time_span(df: DataFrame, dt: str = "dt") -> DataFrame:
    span = F.floor((seconds(F.max(dt)) - seconds(F.min(dt))) / SECONDS_PER_DAY).cast("long")
    return df.agg(F.min(dt).alias("start"), F.max(dt).alias("end"), span.alias("duration_days"))


def dimensions(df: DataFrame) -> DataFrame:
    # Few combinations are left after the first distinct, so counting them is cheap.
    combos = df.select("store_id", "product_id", "city_id").distinct()
    return combos.agg(
        F.count_distinct("store_id").alias("unique_stores"),
        F.count_distinct("product_id").alias("unique_products"),
        F.count_distinct("city_id").alias("unique_cities"),
        F.count_distinct(
            F.when(F.col("store_id").isNotNull() & F.col("product_id").isNotNull(), F.struct("store_id", "product_id"))
        ).alias("total_store_product_combinations"),
    )


def target_summary(df: DataFrame, y: str = "sale_amount") -> DataFrame:
    median = percentile_row(df.select(y), [y], [0.5]).scalar()
    zero = F.count(F.when(F.col(y) == 0, 1)) / F.count(F.lit(1)) * 100
    stats = df.agg(exact_avg(y).alias("mean_sales"), zero.alias("zero_sales_percentage"), F.max(y).alias("max_sales"))
    return stats.select("mean_sales", median.alias("median_sales"), "zero_sales_percentage", "max_sales")


def stockout(df: DataFrame, stock: str = "hours_stock_status") -> DataFrame:
    out = F.col(stock) == 0
    n_out = F.count(F.when(out, 1))
    return df.agg(
        F.count(F.lit(1)).alias("total_observations"),
        n_out.alias("stockout_hours"),
        (n_out / F.count(F.lit(1)) * 100).alias("stockout_rate_percent"),
        F.count_distinct(F.when(out, F.col("store_id"))).alias("stores_with_stockouts"),
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column, as (column, missing), in one pass."""
    one = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing")) for c in df.columns])
    return one.select(F.inline(pairs))


def duplicate_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """How many rows repeat an earlier one; copies combine before the shuffle."""
    copies = df.groupBy(*(subset or df.columns)).agg(F.count(F.lit(1)).alias("n"))
    return copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def describe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, std, min, exact quartiles and max of every numeric column, with its type."""
    cols = list(cols or numeric_columns(df.schema))
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    one = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.lit(types[c]).alias("dtype"),
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in cols
        ]
    )
    moments = one.select(F.inline(F.array(*[F.col(c) for c in cols])))
    quartile = {0.25: "q25", 0.5: "q50", 0.75: "q75"}
    wide = exact_percentiles(df, cols, list(quartile)).groupBy(F.col("name").alias("column")).agg(
        *[F.max(F.when(F.col("q") == q, F.col("value"))).alias(n) for q, n in quartile.items()]
    )
    # One row per column of the table.
    return moments.join(F.broadcast(wide), "column", "left").select(
        "column", "dtype", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def target_moments(df: DataFrame, y: str = "sale_amount") -> DataFrame:
    median = percentile_row(df.select(y), [y], [0.5]).scalar()
    stats = df.agg(exact_avg(y).alias("mean"), F.stddev_samp(y).alias("std"), F.skewness(y).alias("skewness"))
    return stats.select("mean", median.alias("median"), "std", "skewness")


def zero_ratio(df: DataFrame, y: str = "sale_amount") -> DataFrame:
    return df.agg((F.count(F.when(F.col(y) == 0, 1)) / F.count(F.lit(1))).alias("zero_ratio"))


def histogram(df: DataFrame, y: str = "sale_amount", bins: int = 50) -> DataFrame:
    """Equal-width bins between minimum and maximum; the last one is closed."""
    ends = df.agg(F.struct(F.min(y).alias("lo"), F.max(y).alias("hi")).alias("e")).scalar()
    lo, width = ends.getField("lo"), ends.getField("hi") - ends.getField("lo")
    spread = F.floor((F.col(y) - lo) / F.nullif(width, F.lit(0.0)) * bins)
    index = F.least(F.coalesce(spread, F.lit(0).cast("long")), F.lit(bins - 1).cast("long")).cast("int")
    counted = (
        df.filter(F.col(y).isNotNull())
        .select(index.alias("bin"), lo.alias("lo"), width.alias("width"))
        .groupBy("bin", "lo", "width")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.select(
        "bin",
        (F.col("lo") + F.col("width") * F.col("bin") / bins).alias("bin_start"),
        (F.col("lo") + F.col("width") * (F.col("bin") + 1) / bins).alias("bin_end"),
        "n",
    )


def mean_by_hour(df: DataFrame, y: str = "sale_amount") -> DataFrame:
    return df.groupBy(F.hour("dt").cast("int").alias("hour")).agg(exact_avg(y).alias("avg_sales"))


def mean_by_weekday(df: DataFrame, y: str = "sale_amount") -> DataFrame:
    return df.groupBy(weekday_monday0("dt").alias("day_of_week")).agg(exact_avg(y).alias("avg_sales"))


def hour_weekday_matrix(df: DataFrame, y: str = "sale_amount") -> DataFrame:
    cells = df.select(F.hour("dt").cast("int").alias("hour"), weekday_monday0("dt").alias("dow"), y)
    wide = cells.groupBy("hour").pivot("dow", list(range(7))).agg(exact_avg(y))
    return wide.select("hour", *[F.col(str(d)).alias(f"dow_{d}") for d in range(7)])


def stockout_profile(df: DataFrame, y: str = "sale_amount", stock: str = "hours_stock_status") -> DataFrame:
    """Stock-out rate and mean sales in and out of stock; an unknown status counts as in stock."""
    out = F.coalesce(F.col(stock) == 0, F.lit(False))
    return df.agg(
        (F.count(F.when(out, 1)) / F.count(F.lit(1))).alias("stockout_rate"),
        exact_avg_when(~out, y).alias("avg_sales_in_stock"),
        exact_avg_when(out, y).alias("avg_sales_out_of_stock"),
    )


def stockout_by_hour(df: DataFrame, stock: str = "hours_stock_status") -> DataFrame:
    flagged = df.select(
        F.hour("dt").cast("int").alias("hour"), F.coalesce((F.col(stock) == 0).cast("int"), F.lit(0)).alias("out")
    )
    return flagged.groupBy("hour").agg(share("out").alias("stockout_rate"))


def top_stores(df: DataFrame, n: int = 10, y: str = "sale_amount") -> DataFrame:
    totals = df.groupBy("store_id").agg(exact_sum(y).alias("total_sales"))
    return totals.orderBy(F.desc_nulls_last("total_sales"), "store_id").limit(n)


def outlier_flag(df: DataFrame, y: str = "sale_amount", threshold: float = 3.0) -> DataFrame:
    stats = df.agg(F.struct(exact_avg(y).alias("mean"), F.stddev_samp(y).alias("std")).alias("s")).scalar()
    z = (F.col(y) - stats.getField("mean")) / F.nullif(stats.getField("std"), F.lit(0.0))
    return df.withColumn("sale_zscore", z).withColumn(
        "outlier_flag", F.coalesce(F.abs(F.col("sale_zscore")) > threshold, F.lit(False))
    )


def validation_report(df: DataFrame, target: str | None = None, max_null_share: float = 0.5) -> DataFrame:
    """Per column: rows, nulls, null share and what is wrong with it."""
    n = F.count(F.lit(1))
    one = df.agg(n.alias("_n"), *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns])
    rows = one.select(F.col("_n").alias("n_rows"), F.inline(pairs))
    null_share = F.col("nulls") / F.nullif(F.col("n_rows"), F.lit(0))
    issue = F.when(F.col("n_rows") == 0, "empty")
    if target is not None:
        issue = issue.when((F.col("column") == target) & (F.col("nulls") > 0), "null target")
    issue = issue.when(null_share > max_null_share, "mostly null").otherwise("ok")
    return rows.select("column", "n_rows", "nulls", null_share.alias("null_share"), issue.alias("issue"))


def validate_input(features: DataFrame, target: DataFrame | str | None = None) -> DataFrame:
    """Raise on an empty table or a target of another length; log columns to look at."""
    name = target if isinstance(target, str) else None
    report = validation_report(features, name)
    found = report.collect()  # one row per column
    if not found or found[0]["n_rows"] == 0:
        raise ValueError("input table is empty")
    if isinstance(target, DataFrame):
        n_target = target.count()
        if n_target != found[0]["n_rows"]:
            raise ValueError(f"features have {found[0]['n_rows']} rows, the target has {n_target}")
    for r in found:
        if r["issue"] != "ok":
            log.warning("column %s: %s (%d nulls)", r["column"], r["issue"], r["nulls"])
    return report


def data_summary(train: DataFrame, evaluation: DataFrame) -> DataFrame:
    """All sections as one row of structs."""
    sections = {
        "time_span": time_span(train),
        "business_dimensions": dimensions(train),
        "target_statistics": target_summary(train),
        "stockout_analysis": stockout(train),
        "duplicates": duplicate_rows(train),
    }
    nulls = null_counts(train).agg(F.map_from_entries(F.collect_list(F.struct("column", "missing"))).alias("m"))
    shapes = shape(train, evaluation).agg(
        F.map_from_entries(F.collect_list(F.struct("dataset", F.struct("n_rows", "n_columns")))).alias("m")
    )
    cols = [df.select(F.struct(*df.columns)).scalar().alias(name) for name, df in sections.items()]
    # Both maps have a fixed number of entries: columns of the table, and two tables.
    return train.sparkSession.range(1).select(
        shapes.scalar().alias("dataset_shape"), *cols, nulls.scalar().alias("missing_values")
    )
