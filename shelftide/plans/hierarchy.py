"""Forecasts on every level of the hierarchy, and levels that add up.

Sales are counted in whole units of ``1 / SCALE``, so sums are exact whatever their order. One aggregation by grouping
sets forecasts all levels at once; two ways make them agree:

- ``bottom_up``: a level is the sum of the series' own forecasts below it;
- ``top_down``: the total's forecast is dealt out to stores and then to a store's products in proportion to their past
  sales. A part ends where its share of the running total ends, rounded down, so parts add up to what was dealt out.

``base`` is each node's own forecast, which does not add up: the same hour of the last week, plus its change against the
week before, never below zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import TARGET
from ..functions.columns import MONEY
from ..operators.series import attach

SCALE = 10_000
WEEK_HOURS = 168
STORE, CATEGORY, PRODUCT = "store_id", "first_category_id", "product_id"
#: Level: its columns. The last one holds the series.
LEVELS: dict[str, tuple[str, ...]] = {
    "total": (), "store": (STORE,), "category": (CATEGORY,), "product": (CATEGORY, PRODUCT),
    "store_category": (STORE, CATEGORY), "store_product": (STORE, CATEGORY, PRODUCT),
}
METHODS = ("base", "bottom_up", "top_down")


def units(y: str | Column) -> Column:
    return (F.col(y) if isinstance(y, str) else y).cast(MONEY).cast("decimal(30,4)") * SCALE


def _weeks(df: DataFrame, split: Column, y: str) -> DataFrame:
    """Series and target hour with the units of the two weeks before ``split`` and of the week after."""
    hours = F.floor((F.unix_seconds("dt") - F.unix_seconds(split)) / 3600)
    week = F.floor(hours / WEEK_HOURS)
    target = F.timestamp_add("HOUR", F.pmod(hours, F.lit(WEEK_HOURS)).cast("int"), split)
    sold = F.coalesce(units(y).cast("long"), F.lit(0))
    in_week = lambda k: F.sum(F.when(F.col("_week") == k, F.col("_sold")).otherwise(0))
    rows = df.filter(F.col("dt").isNotNull()).select(STORE, CATEGORY, PRODUCT, week.alias("_week"), target.alias("dt"), sold.alias("_sold"))
    return rows.filter(F.col("_week").between(-2, 0)).groupBy(STORE, CATEGORY, PRODUCT, "dt").agg(
        in_week(0).alias("actual"), in_week(-1).alias("last"), in_week(-2).alias("before"))


def own_forecast(last: Column, before: Column) -> Column:
    return F.greatest(2 * last - before, F.lit(0))


def _shares(weeks: DataFrame) -> DataFrame:
    """Per series where its share begins and ends among its store's, and its store's among all: one row per series."""
    sizes = weeks.groupBy(STORE, CATEGORY, PRODUCT).agg(F.sum(F.col("last") + F.col("before")).alias("_size"))
    in_store = Window.partitionBy(STORE)
    order = [F.col(PRODUCT).asc_nulls_first(), F.col(CATEGORY).asc_nulls_first()]
    sizes = sizes.withColumns({"_to": F.sum("_size").over(in_store.orderBy(*order)), "_of": F.sum("_size").over(in_store)})
    # One row per store.
    stores = sizes.groupBy(STORE).agg(F.max("_of").alias("_store"))
    every = Window.partitionBy(F.lit(0))
    stores = stores.select(
        F.col(STORE).alias("_s"), "_store", F.sum("_store").over(every.orderBy(F.col(STORE).asc_nulls_first())).alias("_store_to"), F.sum("_store").over(every).alias("_all"))
    return sizes.join(stores, F.col(STORE).eqNullSafe(F.col("_s"))).drop("_s", "_store").withColumns(
        {"_from": F.col("_to") - F.col("_size"), "_store_from": F.col("_store_to") - F.col("_of")})


def dealt(whole: Column, begin: Column, end: Column, of: Column) -> Column:
    """The part of ``whole`` between two points of a running total, in whole units."""
    def down_to(at: Column) -> Column:
        product = whole.cast("decimal(19,0)") * at.cast("decimal(19,0)")
        return F.coalesce(F.call_function("div", product, F.nullif(of, F.lit(0)).cast("decimal(38,0)")), F.lit(0))

    return down_to(end) - down_to(begin)


def hierarchy_forecast(df: DataFrame, split: Column, y: str = TARGET) -> DataFrame:
    """The week from ``split`` on, for every node of every level: ``level``, its columns (null where they are summed over),
    ``dt``, and the units ``actual``, ``base``, ``bottom_up`` and ``top_down``.

    Every node of a series with a row in the three weeks has a row for every hour of the week. Rows without a time are left out; null keys are a key of their own; null sales count as none.
    """
    keys = [STORE, CATEGORY, PRODUCT]
    weeks = _weeks(df, split, y)
    # Every series takes part in every hour, or what is dealt to it there would be lost.
    hours = F.transform(F.sequence(F.lit(0), F.lit(WEEK_HOURS - 1)), lambda h: F.timestamp_add("HOUR", h, split))
    grid = _shares(weeks).select("*", F.explode(hours).alias("dt"))
    same = F.lit(True)
    for k in (*keys, "dt"):
        same = same & F.col(f"g.{k}").eqNullSafe(F.col(f"w.{k}"))
    counts = [F.coalesce(f"w.{c}", F.lit(0)).alias(c) for c in ("actual", "last", "before")]
    rows = grid.alias("g").join(weeks.alias("w"), same, "left").select("g.*", *counts)
    # One row per hour of the week.
    totals = weeks.groupBy("dt").agg(own_forecast(F.sum("last"), F.sum("before")).alias("_total"))
    rows = attach(rows, totals, ["dt"], WEEK_HOURS).withColumn("_total", F.coalesce("_total", F.lit(0)))
    of_store = dealt(F.col("_total"), F.col("_store_from"), F.col("_store_to"), F.col("_all"))
    rows = rows.withColumn("_of_store", of_store).select(
        *keys, "dt", "actual", "last", "before", own_forecast(F.col("last"), F.col("before")).alias("bottom_up"),
        dealt(F.col("_of_store"), F.col("_from"), F.col("_to"), F.col("_of")).alias("top_down"))
    sets = [[F.col(c) for c in (*cols, "dt")] for cols in LEVELS.values()]
    summed = rows.groupingSets(sets, *keys, "dt").agg(
        F.grouping_id().alias("_level"), *[F.sum(c).alias(c) for c in ("actual", "last", "before", "bottom_up", "top_down")])
    # A bit per column that is summed over, the first one highest; dt never is.
    names = {sum(8 >> keys.index(k) for k in keys if k not in cols): name for name, cols in LEVELS.items()}
    level = F.element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), F.col("_level").cast("int"))
    return summed.select(
        level.alias("level"), *keys, "dt", "actual", own_forecast(F.col("last"), F.col("before")).alias("base"), "bottom_up", "top_down")


def hierarchy_metrics(forecast: DataFrame) -> DataFrame:
    """Per level and method: nodes' hours, mean absolute error in money, and error over sales."""
    methods = F.array(*[F.struct(F.lit(m).alias("method"), F.abs(F.col("actual") - F.col(m)).alias("miss")) for m in METHODS])
    return forecast.select("level", "actual", F.inline(methods)).groupBy("level", "method").agg(
        F.count(F.lit(1)).alias("n"), (F.sum("miss") / F.count(F.lit(1)) / SCALE).alias("mae"),
        (F.sum("miss") / F.nullif(F.sum("actual"), F.lit(0))).alias("wape"))
