"""Ordered work over the rows of a group when one group may be very large.

Most groups are short and run as ordinary windows. A group longer than
``hot_rows`` is cut into blocks of consecutive rows; each block also gets copies
of the few neighbouring rows its frames reach back or ahead to, so the results
equal those of the uncut group. Row positions come from counts per hour, which
are aggregated before anything is shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import hour_cell, same_keys
from ..session import checkpoint_folder

# Groups beyond this are cut; a step that has any writes its input once, so that both
# parts of it, and the steps before, are read and not computed again.
HOT_ROWS = 5_000_000
BLOCK_ROWS = 1_000_000
BROADCAST_KEYS = 500_000

_HELPERS = ("_cell", "_before", "_pos", "_block", "_copy")

Transform = Callable[[DataFrame, Sequence[str], Sequence[str | Column]], DataFrame]


def written(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder."""
    path = f"{checkpoint_folder(df.sparkSession)}/rows-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def longest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the largest group, from a count that combines on the map side."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.max("n")).first()[0] or 0


def split_hot(df: DataFrame, keys: Sequence[str], hot_rows: int) -> tuple[DataFrame, DataFrame]:
    """Rows of groups up to ``hot_rows`` long, and rows of longer ones."""
    hot = (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows).select(*keys)
    )
    # There are at most rows / hot_rows such keys.
    hot = F.broadcast(hot).alias("h")
    cond = same_keys("d", "h", keys)
    left = df.alias("d")
    return left.join(hot, cond, "left_anti"), left.join(hot, cond, "left_semi")


def positions(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], cell: Column) -> DataFrame:
    """Add ``_pos``, the 0-based place of a row in its group, without ordering whole groups.

    ``cell`` must not decrease along ``order``; rows are ordered only inside a cell.
    """
    df = df.withColumn("_cell", cell)
    cells = df.groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    along = Window.partitionBy(*keys).orderBy("_cell")
    offsets = cells.select(*keys, "_cell", (F.sum("_n").over(along) - F.col("_n")).alias("_before"))
    inside = Window.partitionBy(*keys, "_cell").orderBy(*order)
    placed = df.alias("d").join(offsets.alias("o"), same_keys("d", "o", [*keys, "_cell"]))
    return placed.select("d.*", "o._before").withColumn(
        "_pos", F.col("_before") + F.row_number().over(inside) - 1
    )


def blocks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    cell: Column,
    lookback: int,
    lookahead: int,
    block_rows: int,
) -> DataFrame:
    """Rows with their ``_block``; rows near a border also as copies in the neighbour."""
    size = max(block_rows, lookback, lookahead, 1)
    pos, block = F.col("_pos"), F.floor(F.col("_pos") / size)
    place = F.pmod(pos, F.lit(size))
    options = [F.struct(block.alias("_block"), F.lit(False).alias("_copy"))]
    if lookback:
        options.append(F.when(place >= size - lookback, F.struct((block + 1).alias("_block"), F.lit(True).alias("_copy"))))
    if lookahead:
        options.append(F.when(place < lookahead, F.struct((block - 1).alias("_block"), F.lit(True).alias("_copy"))))
    placed = positions(df, keys, order, cell)
    return placed.select("*", F.inline(F.filter(F.array(*options), lambda x: x.isNotNull())))


def over_series(
    df: DataFrame,
    transform: Transform,
    keys: Sequence[str],
    order: Sequence[str | Column] = ("dt",),
    *,
    lookback: int = 0,
    lookahead: int = 0,
    cell: Column | None = None,
    hot_rows: int = HOT_ROWS,
    block_rows: int = BLOCK_ROWS,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Apply ``transform(df, partition columns, order columns)`` within each group.

    The transform may look at most ``lookback`` rows back and ``lookahead`` rows
    ahead, and must keep the rows and columns it is given. ``sized_by`` is a cheaper
    frame with the same groups to measure, such as the table ``df`` was built from.
    """
    if longest_group(df if sized_by is None else sized_by, keys) <= hot_rows:
        return transform(df, list(keys), list(order))
    cell = hour_cell("dt") if cell is None else cell
    cold, hot = split_hot(written(df), keys, hot_rows)
    cut = blocks(hot, keys, order, cell, lookback, lookahead, block_rows)
    done = transform(cut, [*keys, "_block"], ["_pos"])
    done = done.filter(~F.col("_copy")).drop(*_HELPERS)
    return transform(cold, list(keys), list(order)).unionByName(done)


def with_position(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column] = ("dt",),
    *,
    name: str = "position",
    cell: Column | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add the 0-based place of each row in its group."""
    plain = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    if longest_group(df, keys) <= hot_rows:
        return df.withColumn(name, plain)
    cell = hour_cell("dt") if cell is None else cell
    cold, hot = split_hot(written(df), keys, hot_rows)
    placed = positions(hot, keys, order, cell)
    placed = placed.withColumn(name, F.col("_pos").cast("int")).drop("_cell", "_before", "_pos")
    return cold.withColumn(name, plain).unionByName(placed)


def distinct_keys(df: DataFrame, *key_sets: Sequence[str]) -> list[int]:
    """About how many distinct values each set of key columns has, in one pass."""
    sketches = [
        F.approx_count_distinct(F.struct(*ks) if len(ks) > 1 else ks[0]).alias(f"k{i}") for i, ks in enumerate(key_sets)
    ]
    return list(df.agg(*sketches).first())


def attach(
    df: DataFrame,
    stats: DataFrame,
    keys: Sequence[str],
    n_keys: int,
    *,
    spread: bool = False,
    hot_rows: int | None = None,
) -> DataFrame:
    """Left-join one row of statistics per key back to the rows.

    Up to ``BROADCAST_KEYS`` keys the statistics are broadcast and the rows stay where
    they are. Beyond that both sides shuffle, except the rows of keys held by more than
    ``hot_rows`` rows: those keys are few, so their statistics are broadcast to them.
    ``spread`` says that no key can hold many rows, as with keys that contain the hour.
    """
    keys = list(keys)
    if n_keys <= BROADCAST_KEYS:
        return df.join(F.broadcast(stats), keys, "left")
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    if spread or longest_group(df, keys) <= hot_rows:
        return df.join(stats, keys, "left")
    df = written(df)
    cold, hot = split_hot(df, keys, hot_rows)
    hot_keys = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows).select(*keys)
    of_hot = stats.join(F.broadcast(hot_keys), keys, "left_semi")
    return cold.join(stats, keys, "left").unionByName(hot.join(F.broadcast(of_hot), keys, "left"))
