"""Features over the ordered rows of a series.

Lags and windows count rows. Everything on one series is written as a transform
for :func:`over_series`, so several features share one shuffle and one sort.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import LONG_LAGS, SERIES_KEYS, STOCK, STOCKOUT_LAG_MAX, TARGET, VELOCITY_WINDOW, WINDOWS
from ..functions.columns import hour_cell, same_keys
from . import series
from .ranks import dense_rank_desc
from .series import Transform, over_series

# Longer frames are put together from two running aggregates instead of being recomputed per row.
SLIDE_UP_TO = 32
# Longest series handed to pandas whole.
PANDAS_ROWS = 500_000


def chain(*transforms: Transform) -> Transform:
    return lambda df, parts, order: reduce(lambda d, t: t(d, parts, order), transforms, df)


def _window(parts, order):
    return Window.partitionBy(*parts).orderBy(*order)


def per_series(df: DataFrame, parts: Sequence[str], order: Sequence[str | Column], inputs: Sequence[str], names: Sequence[str], fn) -> DataFrame:
    """Add double columns ``names`` that ``fn(*inputs as float arrays, in order)`` gives for each group.

    A group's rows travel as Arrow columns; only the inputs are turned into numbers, the rest is handed back as it came.
    """
    kept = df.columns
    placed = df.withColumn("_seq", F.row_number().over(_window(parts, order)))
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, T.DoubleType()) for n in names]])

    def run(table: pa.Table) -> pa.Table:
        seq = table.column("_seq").to_numpy()
        if len(seq) > 1 and not (seq[1:] > seq[:-1]).all():
            table = table.take(np.argsort(seq, kind="stable"))
        found = fn(*[table.column(c).to_numpy(zero_copy_only=False).astype("float64") for c in inputs])
        out = table.select(kept)
        for n in names:
            out = out.append_column(n, pa.array(found[n], pa.float64(), from_pandas=True))
        return out

    return placed.groupBy(*parts).applyInArrow(run, schema)


# --- lags and differences ----------------------------------------------------

def lag_columns(y: str, lags: Iterable[int], stock: str | None = None) -> Transform:
    def apply(df, parts, order):
        w = _window(parts, order)
        new = {f"{y}_lag_{k}": F.lag(y, k).over(w) for k in lags}
        if stock:
            new |= {f"stockout_lag_{k}": F.lag(stock, k).over(w) for k in lags if k <= STOCKOUT_LAG_MAX}
        return df.withColumns(new)

    return apply


def lag_features(
    df: DataFrame,
    lags: Sequence[int] = LONG_LAGS,
    y: str = TARGET,
    stock: str | None = None,
    keys: Sequence[str] = SERIES_KEYS,
    order: Sequence[str] = ("dt",),
    **hot,
) -> DataFrame:
    return over_series(df, lag_columns(y, lags, stock), keys, order, lookback=max(lags), **hot)


def stockout_lags(df: DataFrame, lags: Sequence[int] = LONG_LAGS, stock: str = STOCK, **hot) -> DataFrame:
    short = [k for k in lags if k <= STOCKOUT_LAG_MAX]

    def apply(d, parts, order):
        w = _window(parts, order)
        return d.withColumns({f"stockout_lag_{k}": F.lag(stock, k).over(w) for k in short})

    return over_series(df, apply, SERIES_KEYS, lookback=max(short), **hot)


def holiday_columns(holiday: str = "holiday_flag") -> Transform:
    def apply(df, parts, order):
        w = _window(parts, order)
        return df.withColumns({
            "day_before_holiday": F.coalesce(F.lead(holiday, 1).over(w), F.lit(0)),
            "day_after_holiday": F.coalesce(F.lag(holiday, 1).over(w), F.lit(0)),
        })

    return apply


def holiday_adjacent(df: DataFrame, holiday: str = "holiday_flag", **hot) -> DataFrame:
    return over_series(df, holiday_columns(holiday), SERIES_KEYS, lookback=1, lookahead=1, **hot)


def change_columns(names: dict[str, str]) -> Transform:
    """First differences; the first row of a series, and a gap, count as no change."""

    def apply(df, parts, order):
        w = _window(parts, order)
        return df.withColumns(
            {new: F.coalesce(F.col(c) - F.lag(c, 1).over(w), F.lit(0.0)) for c, new in names.items()}
        )

    return apply


def weather_change(
    df: DataFrame, temperature: str = "avg_temperature", precipitation: str = "precpt", **hot
) -> DataFrame:
    names = {temperature: "temp_change", precipitation: "precip_change"}
    return over_series(df, change_columns(names), SERIES_KEYS, lookback=1, **hot)


def discount_change(df: DataFrame, discount: str = "discount", **hot) -> DataFrame:
    return over_series(df, change_columns({discount: "discount_change"}), SERIES_KEYS, lookback=1, **hot)


# --- rolling statistics ------------------------------------------------------

def _summary_over(y: str, frame, stats: set[str]) -> Column:
    """Mergeable summary of a frame, with the parts the statistics need."""
    c = F.col(y).cast("double")
    parts = [F.count(c).over(frame).alias("n")]
    if stats & {"mean", "std"}:
        parts.append(F.avg(c).over(frame).alias("mean"))
    if "std" in stats:
        parts.append(F.var_pop(c).over(frame).alias("var"))
    parts += [f(c).over(frame).alias(n) for n, f in (("min", F.min), ("max", F.max)) if n in stats]
    return F.struct(*parts)


def _merged(a: Column, b: Column, stats: set[str]) -> dict[str, Column]:
    """Statistics of two disjoint summaries; either may be missing."""
    def known(s: Column, part: str) -> Column:
        return F.coalesce(s.getField(part), F.lit(0.0))

    na, nb = F.coalesce(a.getField("n"), F.lit(0)), F.coalesce(b.getField("n"), F.lit(0))
    n = na + nb
    some = F.nullif(n, F.lit(0))
    out = {"n": n}
    if stats & {"mean", "std"}:
        ma, mb = known(a, "mean"), known(b, "mean")
        out["mean"] = (ma * na + mb * nb) / some
    if "std" in stats:
        spread = known(a, "var") * na + known(b, "var") * nb + (ma - mb) * (ma - mb) * na * nb / some
        out["std"] = F.when(n > 1, F.sqrt(spread / F.nullif(n - 1, F.lit(0))))
    if "min" in stats:
        out["min"] = F.least(a.getField("min"), b.getField("min"))
    if "max" in stats:
        out["max"] = F.greatest(a.getField("max"), b.getField("max"))
    return out


def _quantiles(stats: Iterable[str]) -> dict[str, float]:
    return {s: 0.5 if s == "median" else float(s[1:]) / 100 for s in stats if s == "median" or s[0] == "q"}


def _limits(stats: Sequence[str], hot: dict) -> dict:
    """Quantiles hand whole series to one task, so shorter ones are cut."""
    return {"hot_rows": PANDAS_ROWS, "block_rows": PANDAS_ROWS, **hot} if _quantiles(stats) else hot


def rolling_columns(
    y: str,
    windows: Iterable[int],
    stats: Sequence[str],
    name: str,
    *,
    prior: bool,
    slide_up_to: int = SLIDE_UP_TO,
) -> Transform:
    """Statistics of the last W rows.

    ``prior`` takes the W rows before the current one and gives null unless all W
    values are present; otherwise the frame ends at the current row and may be
    shorter. ``stats`` may hold mean, std, min, max, median and q<percent>.
    ``name`` is a pattern with ``{stat}`` and ``{w}``.

    A short frame is an ordinary sliding window. For a long one the series is cut
    into runs of W rows, and the frame is the end of one run merged with the start
    of the next: two running aggregates per row, whatever W is.
    """
    quantiles = _quantiles(stats)
    sizes = tuple(windows)

    def apply(df, parts, order):
        before = df.columns
        w = _window(parts, order)
        plain = [s for s in stats if s not in quantiles]
        for size in sizes:
            frame = w.rowsBetween(-size, -1) if prior else w.rowsBetween(-(size - 1), 0)
            helpers: list[str] = []
            if size <= slide_up_to or not plain:
                c = F.col(y).cast("double")
                value = {"n": F.count(c).over(frame), "mean": F.avg(c).over(frame), "std": F.stddev_samp(c).over(frame),
                         "min": F.min(c).over(frame), "max": F.max(c).over(frame)}
            else:
                df, value, helpers = _two_runs(df, y, parts, order, size, prior, set(plain))
            wanted: dict[str, Column] = {}
            for s in plain:
                out = value[s]
                if prior:
                    out = F.when(value["n"] >= size, out)
                elif s == "std":
                    out = F.coalesce(out, F.lit(0.0))
                wanted[name.format(stat=s, w=size)] = out
            # What a size needs goes before the next size sorts the rows again.
            df = df.withColumns(wanted).drop(*helpers)
        if quantiles:
            df = _rolling_quantiles(df, y, parts, order, sizes, quantiles, name, prior)
        return df.select(*before, *[name.format(stat=s, w=size) for size in sizes for s in stats])

    return apply


def _rolling_quantiles(df, y, parts, order, sizes, quantiles, name, prior):
    """Order statistics of frames: each series keeps its frame sorted and puts one value in and takes one out per row."""
    names = {(size, s): name.format(stat=s, w=size) for size in sizes for s in quantiles}

    def run(values: np.ndarray) -> dict[str, np.ndarray]:
        x = pd.Series(values)
        x = x.shift(1) if prior else x
        return {n: x.rolling(size, min_periods=size if prior else 1).quantile(quantiles[s]).to_numpy() for (size, s), n in names.items()}

    return per_series(df, parts, order, [y], list(names.values()), run)


def _runs(df, parts, order, size, prior, summary):
    """The two summaries that make up each row's frame of ``size`` rows, and the names of the helper columns.

    ``summary(frame, place)`` is a struct over a frame; ``place`` is the column of a row's place in its run.
    """
    pos, run, place, head, tail, back, ahead = (f"_{c}_{size}" for c in ("pos", "run", "place", "head", "tail", "back", "ahead"))
    whole = _window(parts, order)
    df = df.withColumn(pos, F.row_number().over(whole) - 1)
    df = df.withColumn(run, F.floor(F.col(pos) / size)).withColumn(place, F.pmod(pos, F.lit(size)))
    up = Window.partitionBy(*parts, run).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(*parts, run).orderBy(F.desc(pos)).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn(head, summary(up, place)).withColumn(tail, summary(down, place))
    along = Window.partitionBy(*parts).orderBy(pos)
    # A frame that is exactly one run is covered by its start alone.
    exact = F.col(place) == (0 if prior else size - 1)
    first = F.when(~exact, F.lag(tail, size if prior else size - 1).over(along))
    last = F.lag(head, 1).over(along) if prior else F.col(head)
    df = df.withColumn(back, first).withColumn(ahead, last)
    return df, (F.col(back), F.col(ahead)), [pos, run, place, head, tail, back, ahead]


def _two_runs(df, y, parts, order, size, prior, stats):
    df, (back, ahead), helpers = _runs(df, parts, order, size, prior, lambda frame, _: _summary_over(y, frame, stats))
    return df, _merged(back, ahead, stats), helpers


# --- rolling trend -------------------------------------------------------------

def _line_over(y: str, place: str, frame) -> Column:
    """Mergeable co-moments of a frame against the place of its rows in their run; rows without a value don't count."""
    c = F.col(y).cast("double")
    x = F.when(c.isNotNull(), F.col(place))
    sums = {"n": F.count(c), "x": F.sum(x), "xx": F.sum(x * x), "y": F.sum(c), "xy": F.sum(c * x)}
    return F.struct(*[F.coalesce(f.over(frame), F.lit(0)).alias(n) for n, f in sums.items()])


def _slope(a: Column, b: Column, shift: int) -> tuple[Column, Column]:
    """Count and slope of two runs, the places of ``b`` starting ``shift`` rows after those of ``a``; either may be missing."""
    def part(s: Column, name: str) -> Column:
        return F.coalesce(s.getField(name), F.lit(0))

    nb, bx, by = part(b, "n"), part(b, "x"), part(b, "y")
    n, x, y = part(a, "n") + nb, part(a, "x") + bx + shift * nb, part(a, "y") + by
    xx = part(a, "xx") + part(b, "xx") + 2 * shift * bx + shift * shift * nb
    xy = part(a, "xy") + part(b, "xy") + shift * by
    # Counts and places are whole numbers, so only the sums with y round.
    return n, (n * xy - x * y) / F.nullif(n * xx - x * x, F.lit(0))


def trend_columns(y: str, windows: Iterable[int], name: str, *, prior: bool) -> Transform:
    """Slope of the least-squares line through the last W rows, per row, by the frames of :func:`rolling_columns`.

    A frame is the end of one run of W rows and the start of the next; their co-moments are merged after the places of the
    second are moved by W. ``prior`` frames give null unless all W values are present, others from two values on.
    """

    def apply(df, parts, order):
        before = df.columns
        wanted: list[str] = []
        for size in windows:
            df, (a, b), helpers = _runs(df, parts, order, size, prior, lambda frame, place: _line_over(y, place, frame))
            n, slope = _slope(a, b, size)
            full = n >= size if prior else n > 1
            # What a size needs goes before the next size sorts the rows again.
            wanted.append(name.format(stat="slope", w=size))
            df = df.withColumn(wanted[-1], F.when(full, slope)).drop(*helpers)
        return df.select(*before, *wanted)

    return apply


def rolling_trend(
    df: DataFrame,
    windows: Sequence[int] = WINDOWS,
    y: str = TARGET,
    keys: Sequence[str] = SERIES_KEYS,
    order: Sequence[str] = ("dt",),
    prior: bool = True,
    **hot,
) -> DataFrame:
    """Change of ``y`` per row over the last windows of rows."""
    fn = trend_columns(y, windows, y + ("_roll_{stat}_{w}" if prior else "_rolling_{stat}_{w}"), prior=prior)
    return over_series(df, fn, keys, order, lookback=max(windows) + 1, **hot)


# --- rolling statistics over series ---------------------------------------------

def rolling_incl(
    df: DataFrame,
    windows: Sequence[int] = WINDOWS,
    stats: Sequence[str] = ("mean", "std", "max", "median"),
    y: str = TARGET,
    keys: Sequence[str] = SERIES_KEYS,
    order: Sequence[str] = ("dt",),
    **hot,
) -> DataFrame:
    name = y + "_rolling_{stat}_{w}"
    fn = rolling_columns(y, windows, stats, name, prior=False)
    return over_series(df, fn, keys, order, lookback=max(windows), **_limits(stats, hot))


def rolling_prior(
    df: DataFrame,
    windows: Sequence[int] = WINDOWS,
    stats: Sequence[str] = ("mean", "std", "min", "max", "q25", "q75"),
    y: str = TARGET,
    keys: Sequence[str] = SERIES_KEYS,
    order: Sequence[str] = ("dt",),
    **hot,
) -> DataFrame:
    name = y + "_roll_{stat}_{w}"
    fn = rolling_columns(y, windows, stats, name, prior=True)
    return over_series(df, fn, keys, order, lookback=max(windows) + 1, **_limits(stats, hot))


def velocity_columns(y: str, window: int) -> Transform:
    def apply(df, parts, order):
        frame = _window(parts, order).rowsBetween(-(window - 1), 0)
        full = F.count(y).over(frame) >= window
        total = F.sum(F.col(y).cast("decimal(18,4)")).over(frame).cast("double")
        return df.withColumn("product_velocity", F.when(full, total).otherwise(F.lit(0.0)))

    return apply


def product_velocity(
    df: DataFrame, y: str = TARGET, window: int = VELOCITY_WINDOW, product: str = "product_id",
    order: Sequence[str] = ("dt", "store_id"), **hot,
) -> DataFrame:
    """Sales over the last rows of a product across stores; 0 until the window is full."""
    return over_series(df, velocity_columns(y, window), [product], order, lookback=window, **hot)


def sales_rank(
    df: DataFrame, y: str = TARGET, category: str = "first_category_id", source: DataFrame | None = None
) -> DataFrame:
    return dense_rank_desc(df, [category], y, "product_sales_rank", source)


# --- exponentially weighted mean ---------------------------------------------

def ewm_prior(
    df: DataFrame,
    spans: Sequence[int] = WINDOWS,
    y: str = TARGET,
    keys: Sequence[str] = SERIES_KEYS,
    order: Sequence[str] = ("dt",),
    *,
    hot_rows: int = PANDAS_ROWS,
    block_rows: int = PANDAS_ROWS,
    cell: Column | None = None,
) -> DataFrame:
    """Exponentially weighted mean of the rows before the current one.

    Each value depends on all before it, which no window frame expresses, so short
    series go to pandas one at a time. A long series is scanned block by block: the
    mean inside a block is linear in the mean it starts from, so blocks run in
    parallel and only their end coefficients are chained.
    """
    names = [f"{y}_ewm_{s}" for s in spans]

    def short(values: np.ndarray) -> dict[str, np.ndarray]:
        x = pd.Series(values).shift(1)
        return {n: x.ewm(span=s, adjust=False).mean().to_numpy() for n, s in zip(names, spans)}

    if series.longest_group(df, keys) <= hot_rows:
        return per_series(df, keys, order, [y], names, short)
    cell = hour_cell("dt") if cell is None else cell
    df = series.written(df)
    cold, hot = series.split_hot(df, keys, hot_rows)
    done = _ewm_blocks(df, hot, spans, names, y, keys, order, cell, block_rows)
    return per_series(cold, keys, order, [y], names, short).unionByName(done)


def _ewm_blocks(df, hot, spans, names, y, keys, order, cell, block_rows):
    cut = series.blocks(hot, keys, order, cell, 1, 0, block_rows)
    prior = F.lag(F.col(y).cast("double"), 1).over(_window([*keys, "_block"], ["_pos"]))
    rows = cut.withColumn("_x", prior).filter(~F.col("_copy")).select(*df.columns, "_block", "_pos", "_x")

    # Place of the last value seen before each block: one row per block.
    seen = rows.groupBy(*keys, "_block").agg(F.max(F.when(F.col("_x").isNotNull(), F.col("_pos"))).alias("_last"))
    earlier = _window(keys, ["_block"]).rowsBetween(Window.unboundedPreceding, -1)
    seen = seen.withColumn("_seen", F.max("_last").over(earlier)).drop("_last")
    # Few rows, which adaptive execution broadcasts after measuring them.
    rows = rows.alias("d").join(seen.alias("o"), same_keys("d", "o", [*keys, "_block"])).select("d.*", "o._seen")

    slopes, bases = [f"_p{i}" for i in range(len(spans))], [f"_q{i}" for i in range(len(spans))]

    def scan(pos: np.ndarray, x: np.ndarray, seen_before: np.ndarray) -> dict[str, np.ndarray]:
        seen_at = seen_before[0]
        fresh = np.isnan(seen_at)
        known = np.flatnonzero(~np.isnan(x))
        new = {}
        for i, s in enumerate(spans):
            def ewm(start, values):
                if fresh:
                    return pd.Series(values).ewm(span=s, adjust=False).mean().to_numpy()
                out = np.full(len(values), start)
                if known.size:
                    # The start's weight shrinks with every row since the last value seen.
                    first, alpha = known[0], 2 / (s + 1)
                    kept = (1 - alpha) ** float(pos[first] - seen_at)
                    rest = values[first:].copy()
                    rest[0] = (kept * start + alpha * rest[0]) / (kept + alpha)
                    out[first:] = pd.Series(rest).ewm(span=s, adjust=False).mean().to_numpy()
                return out
            new[bases[i]] = ewm(0.0, x)
            new[slopes[i]] = np.zeros(len(x)) if fresh else ewm(1.0, np.where(np.isnan(x), np.nan, 0.0))
        return new

    scanned = per_series(rows, [*keys, "_block"], ["_pos"], ["_pos", "_x", "_seen"], [*slopes, *bases], scan)
    ends = scanned.groupBy(*keys, "_block").agg(
        *[F.max_by(c, "_pos").alias(c) for c in [*slopes, *bases]]
    )
    starts = [f"_s{i}" for i in range(len(spans))]

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_block")
        out = pdf[[*keys, "_block"]].copy()
        for p, q, s in zip(slopes, bases, starts):
            mean, at_start = np.nan, []
            for slope, base in zip(pdf[p], pdf[q]):
                at_start.append(mean)
                mean = base if np.isnan(mean) else slope * mean + base
            out[s] = at_start
        return out

    start_schema = T.StructType(
        [f for f in ends.schema if f.name in (*keys, "_block")] + [T.StructField(s, T.DoubleType()) for s in starts]
    )
    # One row per block again.
    chained = ends.groupBy(*keys).applyInPandas(fold, start_schema)
    joined = scanned.alias("d").join(chained.alias("o"), same_keys("d", "o", [*keys, "_block"]))
    means = [
        F.nanvl(F.col(f"d.{q}") + F.col(f"d.{p}") * F.coalesce(F.nanvl(F.col(f"o.{s}"), F.lit(0.0)), F.lit(0.0)),
                F.lit(None).cast("double")).alias(n)
        for p, q, s, n in zip(slopes, bases, starts, names)
    ]
    return joined.select(*[F.col(f"d.{c}") for c in df.columns], *means)
