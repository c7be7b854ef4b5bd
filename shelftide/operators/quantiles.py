"""Exact order statistics without gathering or shuffling a column.

A column with few distinct values is reduced to a count per value. Of others, the range that holds a wanted rank is cut
into buckets again and again, straight from the rows: each round sums a histogram on the map side, with the least and
greatest value of each bucket, and only the bucket with the wanted rank goes on. As a bucket's range is that of its values, one outlier costs one round and no more. What shuffles is histograms,
never values, until a bucket is small enough for its values to be counted one by one.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from functools import reduce
from math import ceil, floor, isinf

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Buckets per doubling of the value.
BUCKETS_PER_OCTAVE = 4096
# Values closer to zero than this share one bucket per sign.
SMALLEST = 1e-30
# The greatest and the least positive double.
GREATEST, LEAST = sys.float_info.max, 5e-324
# Buckets a range is cut into per round.
BUCKETS = 4096
# Rows of a bucket up to which its values are counted one by one.
FEW_ROWS = 20_000
# Distinct values of a column up to which all are counted.
FEW_VALUES = 200_000


def magnitude_bucket(value: Column) -> Column:
    """Integer bucket that never decreases as the value grows."""
    size = F.abs(value)
    octave = F.floor(F.log2(F.greatest(size, F.lit(SMALLEST))) * BUCKETS_PER_OCTAVE)
    lowest = F.floor(F.log2(F.lit(SMALLEST)) * BUCKETS_PER_OCTAVE)
    step = octave - lowest + 1
    return F.when(value == 0, F.lit(0).cast("long")).when(value > 0, step).otherwise(-step)


def _place(value: Column, low: float, high: float, by_size: bool) -> Column:
    """Bucket of a value in [low, high]: never decreasing, the ends in different buckets unless they are equal.

    ``by_size`` cuts by the logarithm of the distance from zero, which parts values of very different sizes.
    """
    value = F.greatest(F.least(value, F.lit(GREATEST)), F.lit(-GREATEST)) if isinf(low) or isinf(high) else value
    low, high = max(low, -GREATEST), min(high, GREATEST)
    if by_size:
        unit = max(max(abs(low), abs(high)) * 2.0**-60, LEAST)
        value = F.signum(value) * F.log2(1 + F.abs(value) / F.lit(unit))
        # The ends as Spark has them, as the last bit of a logarithm may differ.
        ends = [F.signum(F.lit(v)) * F.log2(1 + F.abs(F.lit(v)) / F.lit(unit)) for v in (low, high)]
        half, width = ends[0] / 2, ends[1] / 2 - ends[0] / 2
        part = F.when(width > 0, (value / 2 - half) / F.nullif(width, F.lit(0.0))).otherwise(0.0)
    else:
        # Halves, so that a range over all doubles does not overflow.
        width = high / 2 - low / 2
        part = (value / 2 - F.lit(low / 2)) / F.lit(width) if width > 0 else F.lit(0.0)
    return F.least(F.floor(part * BUCKETS), F.lit(BUCKETS - 1)).cast("int")


def _between(low: float, high: float, at: float) -> float:
    """Linear interpolation, in the formula of the built-in percentile."""
    return low if low == high else (ceil(at) - at) * low + (at - floor(at)) * high


class _Range:
    """Values of a column between ``low`` and ``high``, of which ``before`` are smaller; ``ranks`` are wanted."""

    def __init__(self, name: str, low: float, high: float, before: int, n: int, ranks: list[int], stuck: bool = False):
        self.name, self.low, self.high, self.before, self.n, self.ranks, self.stuck = name, low, high, before, n, ranks, stuck

    def holds(self) -> Column:
        return F.col(self.name).between(F.lit(self.low), F.lit(self.high))


def _inside(held: DataFrame, ranges: list[_Range], what) -> DataFrame:
    """``range`` and ``what(value, range)`` of the values inside ranges.

    Every column is read on its own. Ranges of one column don't overlap.
    """
    found = []
    for name in dict.fromkeys(r.name for r in ranges):
        own = [(k, r) for k, r in enumerate(ranges) if r.name == name]
        number, value = F.lit(None), F.lit(None)
        # -0.0 and 0.0 are one value.
        plain = F.col(name) + F.lit(0.0)
        for k, r in reversed(own):
            number = F.when(r.holds(), F.lit(k)).otherwise(number)
            value = F.when(r.holds(), what(plain, r)).otherwise(value) if len(own) > 1 else what(plain, r)
        found.append(held.select(number.cast("int").alias("range"), value.alias("what"), plain.alias("value")).filter(F.col("range").isNotNull()))
    return reduce(DataFrame.union, found)


def _cut(held: DataFrame, ranges: list[_Range], by_size: bool) -> list[_Range]:
    """The buckets of ``ranges`` that hold their wanted ranks."""
    placed = _inside(held, ranges, lambda value, r: _place(value, r.low, r.high, by_size)).withColumnRenamed("what", "bucket")
    hist = placed.groupBy("range", "bucket").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("least"), F.max("value").alias("most"))
    before = F.sum("n").over(Window.partitionBy("range").orderBy("bucket")) - F.col("n")
    wanted = F.element_at(F.create_map(*[x for k, r in enumerate(ranges) for x in (F.lit(k), F.array(*[F.lit(i - r.before) for i in r.ranks]))]), F.col("range"))
    hist = hist.withColumn("before", before)
    held = F.filter(wanted, lambda i: (i >= F.col("before")) & (i < F.col("before") + F.col("n")))
    # At most one row per wanted rank.
    picked = hist.withColumn("held", held).filter(F.size("held") > 0).collect()
    out = []
    for p in picked:
        r = ranges[p["range"]]
        # Only an infinity beside the greatest numbers can't be cut off.
        stuck = p["n"] == r.n and not by_size
        out.append(_Range(r.name, p["least"], p["most"], r.before + p["before"], p["n"], [i + r.before for i in p["held"]], stuck))
    return out


def _counted(held: DataFrame, ranges: list[_Range]) -> dict[tuple[str, int], float]:
    """The values at the wanted ranks of small ranges."""
    counts = _inside(held, ranges, lambda value, _: F.lit(None)).groupBy("range", "value").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("range").orderBy("value")) - F.col("n")
    wanted = F.element_at(F.create_map(*[x for k, r in enumerate(ranges) for x in (F.lit(k), F.array(*[F.lit(i - r.before) for i in r.ranks]))]), F.col("range"))
    counts = counts.withColumn("before", before)
    held = F.filter(wanted, lambda i: (i >= F.col("before")) & (i < F.col("before") + F.col("n")))
    picked = counts.withColumn("held", held).filter(F.size("held") > 0).collect()
    return {(ranges[p["range"]].name, i + ranges[p["range"]].before): p["value"] for p in picked for i in p["held"]}


def _of_few(df: DataFrame, cols: Sequence[str], qs: Sequence[float]) -> dict[tuple[str, float], float]:
    """Percentiles of columns with few distinct values, from one count per value, all columns in one pass."""
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in cols])
    rows = df.select(F.inline(pairs)).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    # -0.0 and 0.0 are one value.
    counts = rows.select("name", (F.col("value") + F.lit(0.0)).alias("value")).groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
    at = F.array(*[F.lit(float(x)) for x in qs])
    found = counts.groupBy("name").agg(F.percentile("value", at, F.col("n")).alias("found")).collect()
    return {(r["name"], float(q)): v for r in found for q, v in zip(qs, r["found"], strict=True)}


def _of_many(df: DataFrame, cols: Sequence[str], qs: Sequence[float]) -> dict[tuple[str, float], float]:
    """Percentiles by refinement. The driver sees, per round, one row per column and wanted rank."""
    held = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        known = lambda c: F.when(~F.isnan(c), F.col(c) + F.lit(0.0))
        parts = [F.struct(F.lit(c).alias("name"), F.count(known(c)).alias("n"), F.min(known(c)).alias("low"), F.max(known(c)).alias("high")).alias(c) for c in cols]
        ends = [r for r in held.agg(*parts).first() if r["n"]]
        found: dict[tuple[str, int], float] = {}
        total = {r["name"]: r["n"] for r in ends}
        open_ = [
            _Range(r["name"], r["low"], r["high"], 0, r["n"], sorted({i for q in qs for i in (floor((r["n"] - 1) * q), ceil((r["n"] - 1) * q))}))
            for r in ends
        ]
        turn = 0
        while open_:
            found |= {(r.name, i): r.low for r in open_ for i in r.ranks if r.low == r.high}
            open_ = [r for r in open_ if r.low != r.high]
            few = [r for r in open_ if r.n <= FEW_ROWS or r.stuck]
            if few:
                found |= _counted(held, few)
            open_ = [r for r in open_ if r not in few]
            if open_:
                open_ = _cut(held, open_, turn % 2 == 1)
            turn += 1
    finally:
        held.unpersist()
    at = {(c, float(q)): (n - 1) * q for c, n in total.items() for q in qs}
    return {(c, q): _between(found[c, floor(i)], found[c, ceil(i)], i) for (c, q), i in at.items()}


def percentiles(df: DataFrame, cols: Sequence[str], qs: Sequence[float]) -> dict[tuple[str, float], float | None]:
    """Linearly interpolated percentiles by (column, q); null for a column without values."""
    sizes = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols]).first()
    few = [c for c in cols if sizes[c] <= FEW_VALUES]
    many = [c for c in cols if sizes[c] > FEW_VALUES]
    found = (_of_few(df, few, qs) if few else {}) | (_of_many(df, many, qs) if many else {})
    return {(c, float(q)): found.get((c, float(q))) for c in cols for q in qs}


def exact_percentiles(df: DataFrame, cols: Sequence[str], qs: Sequence[float]) -> DataFrame:
    """The percentiles as (name, q, value); columns without values have no rows."""
    rows = [(c, q, v) for (c, q), v in percentiles(df, cols, qs).items() if v is not None]
    return df.sparkSession.createDataFrame(rows, "name string, q double, value double")


def percentile_row(df: DataFrame, cols: Sequence[str], qs: Sequence[float]) -> DataFrame:
    """One row with a column ``<name>_q<100q>`` per column and percentile."""
    found = percentiles(df, cols, qs)
    names = ", ".join(f"`{quantile_name(c, x)}` double" for c in cols for x in qs)
    return df.sparkSession.createDataFrame([tuple(found[c, float(x)] for c in cols for x in qs)], names)


def quantile_name(c: str, q: float) -> str:
    return f"{c}_q{q * 100:g}"


def median_of(df: DataFrame, c: str) -> DataFrame:
    """One-row frame with the exact median; use ``.scalar()`` to place it in an expression."""
    return percentile_row(df.select(c), [c], [0.5]).select(F.col(quantile_name(c, 0.5)).alias("median"))
