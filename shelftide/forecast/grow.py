"""Forests and boosted trees for Spark ML's models, grown level by level from histograms.

Every column is cut into at most ``max_bins`` bins once; after that a row is a byte per column and its label, kept
in blocks. A level of a tree is one histogram per open node and column, made by numpy over whole blocks, instead of
one object per row. All rows and all bins count, exactly.

- Boosting: rounds follow each other, so the rows are dealt out. Each task sums the histograms of its blocks and the
  driver adds them up: open nodes x columns x bins numbers a level, whatever the number of rows. The residuals travel
  with the blocks and are brought up to date once a round. Up to ``ALONE`` rows one task does it without the jobs.
- Forests: trees do not depend on each other, so the trees are dealt out. Each task is handed all blocks and grows
  its trees alone. Beyond ``HELD`` bytes the blocks and the places of their rows lie in the task's temporary files.

Rules are those of Spark ML: a row goes left up to the threshold, gain is the fall of variance, boosting fits twice
the residual after a first tree of weight 1, forests draw each row Poisson(1) times. Bins come from all rows, not from
a sample, and a frequent value takes one bin and not the places of many.
The fitted trees become Spark ML's own models when they are stored or asked for importances; prediction walks a tree at
a time over a batch of rows.
"""

from __future__ import annotations

import json
import math
import os
import sys
import tempfile
import time
import uuid
import weakref
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import cached_property, partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_folder

# Tasks get the functions themselves, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows that are dealt out together, rows of a block that boosting works on at once, and the same for a forest.
SLICE_ROWS = 2_048
BLOCK_ROWS = 65_536
MERGED_ROWS = 2_097_152
# Values per column and task that stand for its distribution, when it has more.
SUMMARY = 16_384
# Cells of histograms made at once, and bytes a task of a forest keeps in memory.
CELLS = 4_000_000
HELD = 256 << 20
# Boosting: rows up to which one task has all of them, and its blocks; a job for each of hundreds of levels costs more
# than its rows. Beyond that, rows worth a task of their own, and rows from which on there are more tasks than cores.
ALONE = 1_000_000
ALONE_ROWS = 262_144
TASK_ROWS = 32_768
FULL_ROWS = 4_000_000
# Tasks whose histograms the driver adds up by itself.
FEW_TASKS = 32
# Rounds after which boosting writes its blocks to the shared folder.
LINEAGE = 10


# --- bins ----------------------------------------------------------------------

def _numbers(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Columns x rows, and labels."""
    x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).T
    y = batch.column(1).to_numpy(zero_copy_only=False).astype("float64")
    if not np.isfinite(x).all() or np.isnan(y).any():
        raise ValueError("features must be finite, labels must not be null or NaN")
    return x, y


def _fewer(values: np.ndarray, counts: np.ndarray, most: int = SUMMARY) -> tuple[np.ndarray, np.ndarray]:
    """At most about ``most`` of the sorted values; runs of values of equal weight are counted at their largest."""
    if len(values) <= most:
        return values, counts
    upto = counts.cumsum()
    last = np.unique(np.append(np.searchsorted(upto, np.arange(1, most) * (upto[-1] / most)), len(values) - 1))
    return values[last], np.diff(upto[last], prepend=0)


def _add_up(parts: Iterable[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    values, counts = (np.concatenate(p) for p in zip(*parts))
    values, at = np.unique(values, return_inverse=True)
    return values, np.bincount(at, weights=counts).astype("int64")


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Values of each column with their counts, one row per column."""
    found: list = []
    for batch in batches:
        if batch.num_rows:
            for i, column in enumerate(_numbers(batch)[0]):
                new = np.unique(column, return_counts=True)
                if i == len(found):
                    found.append([new])
                    continue
                found[i].append(new)
                if sum(len(v) for v, _ in found[i]) > 16 * SUMMARY:
                    found[i] = [_fewer(*_add_up(found[i]), 4 * SUMMARY)]
    if found:
        rows = [_fewer(*_add_up(f)) for f in found]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(rows)), pa.int32()), pa.array([v for v, _ in rows], pa.list_(pa.float64())),
             pa.array([c for _, c in rows], pa.list_(pa.int64()))], names=["at", "value", "n"],
        )


def thresholds(values: np.ndarray, counts: np.ndarray, max_bins: int) -> np.ndarray:
    """Middles between neighbouring values: all of them, or so many that bins hold about as many rows each.

    A value with more rows than that gets a bin of its own, and the others share what bins are left.
    """
    low, high = values[:-1], values[1:]
    middle = low + (high - low) / 2
    middle = np.where((middle >= high) | ~np.isfinite(middle), low, middle)
    if len(middle) < max_bins:
        return middle
    heavy = counts >= counts.sum() / max_bins
    rows, bins = int(counts[~heavy].sum()), int(max_bins - heavy.sum())
    share, chosen, now = rows / max(bins, 1), [], 0
    for i in range(len(middle)):
        now += counts[i]
        rows -= 0 if heavy[i] else counts[i]
        if heavy[i] or now >= share or (heavy[i + 1] and 2 * now >= share):
            chosen.append(middle[i])
            now, bins = 0, bins - (not heavy[i])
            share = rows / max(bins, 1)
            if len(chosen) == max_bins - 1:
                break
    return np.array(chosen)


def fit_bins(rows: DataFrame, max_bins: int) -> tuple[list[np.ndarray], int]:
    """Thresholds of each column of the rows' vectors, and the number of rows."""
    parts = rows.mapInArrow(_summaries, "at int, value array<double>, n array<long>").toArrow()
    if not parts.num_rows:
        raise ValueError("no rows to fit on")
    at = parts.column("at").to_numpy()
    of: dict[int, list] = {i: [] for i in range(at.max() + 1)}
    for i, v, n in zip(at, parts.column("value"), parts.column("n")):
        of[i].append((v.values.to_numpy(), n.values.to_numpy()))
    merged = [_add_up(of[i]) for i in sorted(of)]
    return [thresholds(*_fewer(*m, 4 * SUMMARY), max_bins) for m in merged], int(merged[0][1].sum())


def _block(cuts: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    kind = np.uint8 if max(len(c) for c in cuts) < 256 else np.uint16
    return np.stack([np.searchsorted(c, column).astype(kind) for c, column in zip(cuts, x)]), y


def _blocks(cuts: list[np.ndarray], part: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Binned rows as bytes, ``SLICE_ROWS`` at a time, with a number that stays theirs."""
    k = 0
    for batch in batches:
        for low in range(0, batch.num_rows, SLICE_ROWS):
            bins, label = _block(cuts, *_numbers(batch.slice(low, SLICE_ROWS)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([part]), pa.array([k]), pa.array([bins.tobytes()], pa.binary()), pa.array([label.tobytes()], pa.binary())],
                names=["part", "k", "bins", "label"],
            )
            k += 1


def _slices(columns: int, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], np.ndarray, np.ndarray]]:
    """Number, columns x rows of bins, and labels."""
    for batch in batches:
        part, k, bins, label = (batch.column(c) for c in ("part", "k", "bins", "label"))
        for i in range(batch.num_rows):
            y = np.frombuffer(label[i].as_buffer(), "float64")
            b = bins[i].as_buffer()
            yield (part[i].as_py(), k[i].as_py()), np.frombuffer(b, np.uint8 if b.size == columns * y.size else np.uint16).reshape(columns, y.size), y


def _merged(slices: Iterator[tuple], rows: int) -> Iterator[tuple[list, list[int], np.ndarray, np.ndarray]]:
    """Blocks of about so many rows: the numbers and sizes of their slices, bins and labels."""
    waiting, n = [], 0

    def close() -> tuple:
        numbers, bins, label = zip(*waiting)
        return list(numbers), [y.size for y in label], np.concatenate(bins, axis=1), np.concatenate(label)

    for one in slices:
        waiting.append(one)
        n += one[2].size
        if n >= rows:
            yield close()
            waiting, n = [], 0
    if waiting:
        yield close()


def pack(rows: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """The rows as numbered slices of bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        yield from _blocks(cuts, TaskContext.get().partitionId(), batches)

    return rows.mapInArrow(run, "part long, k long, bins binary, label binary")


# --- one tree ------------------------------------------------------------------

@dataclass
class Grown:
    """Nodes of a tree, level by level. A leaf stays where it is: its cut is beyond all bins and it is its own left child."""

    columns: int
    bins: int
    subset: int
    depth: int
    min_leaf: int
    feature: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    cut: np.ndarray = field(default_factory=lambda: np.full(1, 1 << 30, np.int64))
    left: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    count: np.ndarray = field(default_factory=lambda: np.zeros(1))
    total: np.ndarray = field(default_factory=lambda: np.zeros(1))
    square: np.ndarray = field(default_factory=lambda: np.full(1, np.nan))
    gain: np.ndarray = field(default_factory=lambda: np.full(1, -1.0))
    level: int = 0
    # Nodes that may be split, and the columns that each of them looks at.
    open: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    chosen: np.ndarray | None = None

    def draw(self, rng: np.random.Generator) -> None:
        m, d = len(self.open), self.columns
        if self.subset >= d:
            self.chosen = np.broadcast_to(np.arange(d), (m, d))
        else:
            self.chosen = np.sort(rng.random((m, d)).argsort(axis=1)[:, : self.subset], axis=1)

    def slots(self) -> np.ndarray:
        """Place among the open nodes of each node; closed ones come after the last."""
        out = np.full(len(self.feature), len(self.open), np.int64)
        out[self.open] = np.arange(len(self.open))
        return out

    def split(self, found: list[np.ndarray]) -> None:
        """Cut the open nodes by what :func:`best_splits` found of them."""
        column, cut, gain, n, s, square, n_left, s_left = found
        self.count[self.open], self.total[self.open], self.square[self.open] = n, s, square
        # Beyond rounding; a node of equal labels has none.
        yes = gain > np.maximum(1e-12 * square, 1e-16 * self.square[0])
        at, start = self.open[yes], len(self.feature)
        left = start + 2 * np.arange(len(at))
        self.feature[at] = self.chosen[np.flatnonzero(yes), column[yes]]
        self.cut[at], self.left[at], self.gain[at] = cut[yes], left, gain[yes] / n[yes]
        new = 2 * len(at)

        def both(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return np.stack([a[yes], b[yes] - a[yes]], axis=1).ravel()

        counts = both(n_left, n)
        self.feature = np.append(self.feature, np.zeros(new, np.int64))
        self.cut = np.append(self.cut, np.full(new, 1 << 30, np.int64))
        self.left = np.append(self.left, start + np.arange(new))
        self.count, self.total = np.append(self.count, counts), np.append(self.total, both(s_left, s))
        self.square, self.gain = np.append(self.square, np.full(new, np.nan)), np.append(self.gain, np.full(new, -1.0))
        self.level += 1
        may = (counts >= 2 * self.min_leaf) & (counts > 1) & (self.level < self.depth)
        self.open = start + np.flatnonzero(may)

    def values(self) -> np.ndarray:
        return self.total / np.maximum(self.count, 1)

    def path(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """What :func:`walk` needs."""
        return self.feature, self.cut, self.left, self.level

    def table(self, tree: int, cuts: list[np.ndarray]) -> pa.RecordBatch:
        """The nodes as Spark stores them."""
        n, inner = len(self.feature), self.gain >= 0
        value = self.values()
        stats = np.stack([self.count, self.total, self.square], axis=1)
        impurity = np.maximum(self.square / np.maximum(self.count, 1) - value * value, 0)
        at = [[float(cuts[f][c])] if i else [] for f, c, i in zip(self.feature, self.cut, inner)]
        split = pa.StructArray.from_arrays(
            [pa.array(np.where(inner, self.feature, -1), pa.int32()), pa.array(at, pa.list_(pa.float64())), pa.array(np.full(n, -1), pa.int32())],
            names=["featureIndex", "leftCategoriesOrThreshold", "numCategories"],
        )
        node = pa.StructArray.from_arrays(
            [pa.array(np.arange(n), pa.int32()), pa.array(value), pa.array(impurity), pa.array(list(stats), pa.list_(pa.float64())),
             pa.array(self.count.astype("int64")), pa.array(self.gain), pa.array(np.where(inner, self.left, -1), pa.int32()),
             pa.array(np.where(inner, self.left + 1, -1), pa.int32()), split],
            names=["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"],
        )
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, tree), pa.int32()), node], names=["treeID", "nodeData"])


def walk(path: tuple[np.ndarray, np.ndarray, np.ndarray, int], bins: np.ndarray) -> np.ndarray:
    """Node of each row."""
    feature, cut, left, levels = path
    n = bins.shape[1]
    flat, rows, node = bins.reshape(-1), np.arange(n), np.zeros(n, np.int64)
    start = feature * n
    for _ in range(levels):
        node = left[node] + (flat[start[node] + rows] > cut[node])
    return node


NODES = (
    "treeID int, nodeData struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,rawCount:bigint,"
    "gain:double,leftChild:int,rightChild:int,split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>>"
)


def best_splits(count: np.ndarray, total: np.ndarray, square: np.ndarray, min_leaf: int) -> list[np.ndarray]:
    """Of histograms nodes x columns x bins: column, bin, gain, rows, sum and squares, rows and sum on the left."""
    left_n, left_s = count.cumsum(2), total.cumsum(2)
    n, s = left_n[:, :1, -1:], left_s[:, :1, -1:]
    left_n, left_s = left_n[..., :-1], left_s[..., :-1]
    right_n = n - left_n
    with np.errstate(divide="ignore", invalid="ignore"):
        apart = left_s / left_n - (s - left_s) / right_n
        gain = left_n * right_n / n * apart * apart
    gain[(left_n < max(min_leaf, 1)) | (right_n < max(min_leaf, 1))] = -np.inf
    m, width = len(count), left_n.shape[2]
    best = gain.reshape(m, -1).argmax(1)
    column, cut = np.divmod(best, width)
    at = (np.arange(m), column, cut)
    return [column, cut, gain[at], n[:, 0, 0], s[:, 0, 0], square, left_n[at], left_s[at]]


# --- boosting ------------------------------------------------------------------

def _drawn(rate: float, key: tuple[int, int], numbers: Sequence[tuple[int, int]], sizes: Sequence[int]) -> np.ndarray | None:
    """Rows that a round uses, whichever task they are in."""
    if rate < 1:
        return np.concatenate([np.random.default_rng([*key, *i]).random(n, dtype=np.float32) < rate for i, n in zip(numbers, sizes)])


def _histogram(path: tuple, slots: np.ndarray, m: int, width: int, bins: np.ndarray, label: np.ndarray, drawn: np.ndarray | None) -> np.ndarray:
    """Rows and sums of labels per column, open node and bin; squares per open node."""
    place = slots[walk(path, bins)]
    if drawn is not None:
        place = np.where(drawn, place, m)
    size = (m + 1) * width
    sums, start = np.empty((2, len(bins), size)), place * width
    for f, column in enumerate(bins):
        at = start + column
        sums[0, f] = np.bincount(at, minlength=size)
        sums[1, f] = np.bincount(at, weights=label, minlength=size)
    square = np.bincount(place, weights=label * label, minlength=m + 1)
    return np.append(sums[:, :, : m * width].ravel(), square[:m])


def _grow(tree: Grown, sums: np.ndarray) -> None:
    """Split the open nodes by the sum of all histograms."""
    m = len(tree.open)
    cube, square = sums[:-m].reshape(2, tree.columns, m, tree.bins).transpose(0, 2, 1, 3), sums[-m:]
    if tree.subset < tree.columns:
        cube = cube[:, np.arange(m)[:, None], tree.chosen]
    tree.split(best_splits(*cube, square, tree.min_leaf))


def _alone(blocks: list, shape: dict, rounds: int, step: float, rate: float, seed: int) -> Iterator[Grown]:
    """All rounds by the task that has all blocks.

    Rows keep their node from level to level. Of two children only the smaller one is counted, the other is the rest of
    their parent.
    """
    for k in range(rounds):
        tree, rng = Grown(**shape), np.random.default_rng([seed, k])
        d, width = tree.columns, tree.bins
        state = []
        for numbers, sizes, bins, rest in blocks:
            drawn = _drawn(rate, (seed, k), numbers, sizes)
            rows = np.arange(rest.size) if drawn is None else np.flatnonzero(drawn)
            state.append([bins if drawn is None else bins[:, rows], (1 if k == 0 else 2) * rest[rows], np.zeros(rows.size, np.int64)])
        cube, square = None, None
        while len(tree.open):
            tree.draw(rng)
            nodes = tree.open
            if cube is None:
                counted, others, parent = nodes, nodes[:0], nodes[:0]
            else:
                # Children come in pairs, left before right, after all nodes of the levels before.
                first = np.unique(nodes - (nodes - base) % 2)
                smaller = tree.count[first] <= tree.count[first + 1]
                counted, others, parent = np.where(smaller, first, first + 1), np.where(smaller, first + 1, first), owner[(first - base) // 2]
            slots = np.full(len(tree.feature), len(counted), np.int64)
            slots[counted] = np.arange(len(counted))
            size = len(counted) * width
            sums, squares = np.zeros((2, d, size)), np.zeros(len(counted))
            for bins, label, place in state:
                at = slots[place]
                if cube is not None:
                    here = np.flatnonzero(at < len(counted))
                    bins, label, at = bins[:, here], label[here], at[here]
                start = at * width
                for f, column in enumerate(bins):
                    cell = start + column
                    sums[0, f] += np.bincount(cell, minlength=size)
                    sums[1, f] += np.bincount(cell, weights=label, minlength=size)
                squares += np.bincount(at, weights=label * label, minlength=len(counted))
            own = sums.reshape(2, d, len(counted), width).transpose(0, 2, 1, 3)
            if cube is not None:
                rest_of = cube[:, parent] - own
                # Nothing but rounding is left where no row is.
                rest_of[1][rest_of[0] == 0] = 0
                own, squares = np.concatenate([own, rest_of], axis=1), np.append(squares, square[parent] - squares)
                order = np.argsort(np.append(counted, others))
                own, squares = own[:, order], squares[order]
                keep = np.isin(np.sort(np.append(counted, others)), nodes)
                own, squares = own[:, keep], squares[keep]
            cube, square = own, squares
            seen = cube
            if tree.subset < d:
                seen = cube[:, np.arange(len(nodes))[:, None], tree.chosen]
            base = len(tree.feature)
            tree.split(best_splits(*seen, square, tree.min_leaf))
            # Places, among the nodes just looked at, of those that were split, in the order of their children.
            owner = np.flatnonzero(tree.gain[nodes] >= 0)
            for s in state:
                bins, _, place = s
                n = place.size
                right = bins.reshape(-1)[(tree.feature * n)[place] + np.arange(n)] > tree.cut[place]
                s[2] = tree.left[place] + right
        yield tree
        values = tree.values() * (1.0 if k == 0 else step)
        for _, _, bins, rest in blocks:
            rest -= values[walk(tree.path(), bins)]


def _add_histograms(path: tuple, slots: np.ndarray, m: int, width: int, columns: int, rate: float, key: tuple[int, int], blocks: Iterator) -> Iterator[np.ndarray]:
    own = np.zeros(m * (2 * columns * width + 1))
    for numbers, sizes, bins, rest in blocks:
        own += _histogram(path, slots, m, width, bins, rest if key[1] == 0 else 2 * rest, _drawn(rate, key, numbers, sizes))
    yield own


def _rest(path: tuple, values: np.ndarray, blocks: Iterator) -> Iterator[tuple]:
    """Blocks with what a tree leaves of their labels."""
    for numbers, sizes, bins, rest in blocks:
        yield numbers, sizes, bins, rest - values[walk(path, bins)]


def _remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _by_jobs(blocks: RDD, spark: SparkSession, shape: dict, rounds: int, step: float, rate: float, seed: int) -> list[Grown]:
    """The same rounds with a job per level, for any number of rows; the driver adds up."""
    held, trees, written = blocks.persist(StorageLevel.MEMORY_AND_DISK), [], []
    few = blocks.getNumPartitions() <= FEW_TASKS
    try:
        for k in range(rounds):
            if k:
                before, last = held, trees[-1]
                held = before.mapPartitions(partial(_rest, last.path(), last.values() * (1.0 if k == 1 else step)), True)
                held.persist(StorageLevel.MEMORY_AND_DISK)
                if k % LINEAGE == 0:
                    held.checkpoint()
            tree, rng = Grown(**shape), np.random.default_rng([seed, k])
            while len(tree.open):
                tree.draw(rng)
                one = partial(_add_histograms, tree.path(), tree.slots(), len(tree.open), tree.bins, tree.columns, rate, (seed, k))
                parts = held.mapPartitions(one)
                _grow(tree, reduce(np.add, parts.collect()) if few else parts.treeReduce(np.add))
                if k and tree.level == 1:
                    before.unpersist()
                    if held.getCheckpointFile():
                        written.append(held.getCheckpointFile())
            trees.append(tree)
            while len(written) > 1:
                _remove(spark, written.pop(0))
    finally:
        held.unpersist()
        for path in written:
            _remove(spark, path)
    return trees


def boost(
    packed: DataFrame, n: int, cuts: list[np.ndarray], shape: dict, rounds: int, step: float, rate: float, seed: int, alone: int = ALONE
) -> DataFrame:
    """Nodes of trees, each fitted to what the ones before leave of the labels."""
    spark = packed.sparkSession
    if n <= alone:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            blocks = list(_merged(_slices(len(cuts), batches), ALONE_ROWS))
            if blocks:
                for t, tree in enumerate(_alone(blocks, shape, rounds, step, rate, seed)):
                    yield tree.table(t, cuts)

        return _dealt(packed, 1).mapInArrow(run, NODES)
    tasks = max(1, min(n // TASK_ROWS, max(spark.sparkContext.defaultParallelism, n // FULL_ROWS)))
    blocks = _dealt(packed, tasks).rdd.mapPartitions(partial(_of_rows, len(cuts)))
    found = _by_jobs(blocks, spark, shape, rounds, step, rate, seed)
    return spark.createDataFrame(pa.Table.from_batches([tree.table(t, cuts) for t, tree in enumerate(found)]), NODES)


def _dealt(packed: DataFrame, tasks: int) -> DataFrame:
    """Every so-manieth slice for each task, in order."""
    return packed.repartitionById(tasks, F.pmod(F.col("k") + F.col("part"), F.lit(tasks)).cast("int")).sortWithinPartitions("part", "k")


def _of_rows(columns: int, rows: Iterable) -> Iterator[tuple]:
    def slices() -> Iterator[tuple]:
        for row in rows:
            y = np.frombuffer(row.label, "float64")
            kind = np.uint8 if len(row.bins) == columns * y.size else np.uint16
            yield (row.part, row.k), np.frombuffer(row.bins, kind).reshape(columns, y.size), y

    return _merged(slices(), BLOCK_ROWS)


# --- forests -------------------------------------------------------------------

class Held:
    """Arrays in memory, and from ``most`` bytes on in files of a temporary folder."""

    def __init__(self, folder: str, most: int) -> None:
        self.folder, self.most, self.used = folder, most, 0

    def keep(self, a: np.ndarray) -> np.ndarray:
        self.used += a.nbytes
        if self.used <= self.most or not a.size:
            return a
        out = np.memmap(f"{self.folder}/{uuid.uuid4().hex}", a.dtype, "w+", shape=a.shape)
        out[:] = a
        return out

    def drop(self, a: np.ndarray) -> None:
        self.used -= a.nbytes
        if isinstance(a, np.memmap) and a.filename:
            os.unlink(a.filename)


def grow_tree(parts: list[tuple[list, list[int], np.ndarray, np.ndarray]], shape: dict, key: tuple[int, int], held: Held) -> Grown:
    """One tree of a forest over all rows. Rows leave when their node is closed."""
    tree, rng = Grown(**shape), np.random.default_rng(key)
    state = []
    for numbers, sizes, _, _ in parts:
        times = np.concatenate([np.random.default_rng([*key, *i]).poisson(1.0, n).astype(np.uint8) for i, n in zip(numbers, sizes)])
        rows = np.flatnonzero(times).astype(np.int32)
        state.append([held.keep(a) for a in (rows, times[rows], np.zeros(rows.size, np.int32))])
    width = tree.bins
    while len(tree.open):
        tree.draw(rng)
        m, k = tree.chosen.shape
        step = max(1, CELLS // (k * width))
        found: list[list[np.ndarray]] = []
        for low in range(0, m, step):
            high = min(m, low + step)
            size = (high - low) * width
            sums, square = np.zeros((2, k, size)), np.zeros(high - low)
            for (_, _, bins, y), (rows, times, place) in zip(parts, state):
                if step < m:
                    here = np.flatnonzero((place >= low) & (place < high))
                    rows, times, place = rows[here], times[here], place[here] - low
                flat, rows, place = bins.reshape(-1), rows.astype(np.int64), place.astype(np.int64)
                label, times = y[rows], times.astype("float64")
                label_times = label * times
                start = place * width
                for j in range(k):
                    column = tree.chosen[low:high, j] * y.size
                    at = start + flat[column[place] + rows]
                    sums[0, j] += np.bincount(at, weights=times, minlength=size)
                    sums[1, j] += np.bincount(at, weights=label_times, minlength=size)
                square += np.bincount(place, weights=label_times * label, minlength=high - low)
            cube = sums.reshape(2, k, high - low, width).transpose(0, 2, 1, 3)
            found.append(best_splits(*cube, square, tree.min_leaf))
        nodes = tree.open
        tree.split([np.concatenate(x) for x in zip(*found)])
        slots = tree.slots()
        start, cut, left = tree.feature[nodes], tree.cut[nodes], tree.left[nodes]
        for (_, _, bins, y), s in zip(parts, state):
            rows, times, place = s
            place = place.astype(np.int64)
            right = bins.reshape(-1)[(start * y.size)[place] + rows] > cut[place]
            place = slots[left[place] + right]
            stay = np.flatnonzero(place < len(tree.open))
            for a in s:
                held.drop(a)
            s[:] = [held.keep(a) for a in (rows[stay], times[stay], place[stay].astype(np.int32))]
    for s in state:
        for a in s:
            held.drop(a)
    return tree


def forest(packed: DataFrame, cuts: list[np.ndarray], shape: dict, trees: int, seed: int) -> DataFrame:
    """Nodes of trees; every task is handed all slices and grows its trees alone."""
    tasks = max(1, min(trees, packed.sparkSession.sparkContext.defaultParallelism))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task: list[int] = []

        def seen() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    task[:] = [batch.column("task")[0].as_py()]
                    yield batch

        with tempfile.TemporaryDirectory() as folder:
            held = Held(folder, HELD)
            parts = [(i, n, held.keep(b), held.keep(y)) for i, n, b, y in _merged(_slices(len(cuts), seen()), MERGED_ROWS)]
            for t in range(task[0], trees, tasks) if task else ():
                yield grow_tree(parts, shape, (seed, t), held).table(t, cuts)

    copies = packed.withColumn("task", F.explode(F.array(*[F.lit(t) for t in range(tasks)])))
    return copies.repartitionById(tasks, F.col("task")).sortWithinPartitions("part", "k").mapInArrow(run, NODES)


# --- prediction ----------------------------------------------------------------

def _predict(trees: tuple, x: np.ndarray) -> np.ndarray:
    """Weighted sum of the trees' values; ``x`` is columns x rows. A tree at a time, so that its nodes stay at hand."""
    feature, threshold, children, value, starts, levels, weights = trees
    n = x.shape[1]
    flat, rows, out = np.ascontiguousarray(x).reshape(-1), np.arange(n), np.zeros(n)
    for low, high, deep, weight in zip(starts, starts[1:], levels, weights):
        start, child, limit = feature[low:high] * n, children[low:high].reshape(-1), threshold[low:high]
        node = np.zeros(n, np.int64)
        for _ in range(deep):
            node = child[2 * node + (flat[start[node] + rows] > limit[node])]
        out += weight * value[low:high][node]
    return out


@dataclass
class Trees:
    """Stored nodes of all trees as arrays, tree after tree, with both children of each; a leaf is its own child."""

    feature: np.ndarray
    threshold: np.ndarray
    child: np.ndarray
    value: np.ndarray
    starts: list[int]
    levels: list[int]
    weights: list[float]

    def predict(self, x: np.ndarray) -> np.ndarray:
        return _predict(tuple(vars(self).values()), x)

    def column(self, spark: SparkSession, inputs: Sequence[Column]) -> Column:
        """The prediction from a row's prepared inputs."""
        shared = spark.sparkContext.broadcast(tuple(vars(self).values()))

        def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for a in arrays:
                x = a.flatten().to_numpy(zero_copy_only=False)
                yield pa.array(_predict(shared.value, x.reshape(len(a), -1).T) if len(a) else x)

        return F.arrow_udf(run, "double")(F.array(*inputs))


def read_trees(spark: SparkSession, path: str, weights: Sequence[float]) -> Trees:
    """The trees of a stored forest or boosted model."""
    node = F.col("nodeData")
    split = node["split"]
    got = spark.read.schema(NODES).parquet(f"{path}/data").select(
        "treeID", node["id"].alias("id"), node["prediction"].alias("value"), node["leftChild"].alias("left"),
        split["featureIndex"].alias("feature"), F.get(split["leftCategoriesOrThreshold"], 0).alias("threshold"),
        node["rightChild"].alias("right"),
    ).toArrow().sort_by([("treeID", "ascending"), ("id", "ascending")])
    tree, value, left, right, feature = (got.column(c).to_numpy() for c in ("treeID", "value", "left", "right", "feature"))
    threshold, leaf = got.column("threshold").to_numpy(), left < 0
    starts = [*np.flatnonzero(np.diff(tree, prepend=-1)).tolist(), len(tree)]
    place = np.arange(len(tree)) - np.repeat(starts[:-1], np.diff(starts))
    child = np.stack([np.where(leaf, place, left), np.where(leaf, place, right)], axis=1).astype(np.int64)
    levels = []
    for low, high in zip(starts, starts[1:]):
        at, n = np.zeros(1, np.int64), 0
        while len(at := at[~leaf[low:high][at]]):
            at, n = child[low:high][at].ravel(), n + 1
        levels.append(n)
    return Trees(np.where(leaf, 0, feature).astype(np.int64), np.where(leaf, np.inf, threshold), child, value, starts, levels, list(weights))


def summed(fitted) -> list[float]:
    """What a Spark model's trees count for: a forest gives their mean, boosted trees their weighted sum."""
    if isinstance(fitted, RandomForestRegressionModel):
        return [1 / fitted.getNumTrees] * fitted.getNumTrees
    return list(fitted.treeWeights)


# --- Spark ML ------------------------------------------------------------------

def columns_per_node(rule: str, columns: int, trees: int) -> int:
    """Spark's names for the number of columns a node looks at."""
    if rule == "auto":
        rule = "all" if trees == 1 else "onethird"
    named = {"all": columns, "sqrt": math.ceil(math.sqrt(columns)), "log2": max(1, math.ceil(math.log2(columns))),
             "onethird": math.ceil(columns / 3)}
    if rule in named:
        return named[rule]
    value = float(rule)
    return min(columns, int(value)) if rule.isdigit() else math.ceil(value * columns)


def _record(stage, cls: str, version: str, **more) -> str:
    """Spark's description of a stored stage."""
    def values(params: dict) -> dict:
        return {p.name: v for p, v in params.items()}

    about = {
        "class": f"org.apache.spark.ml.regression.{cls}", "timestamp": int(time.time() * 1000), "sparkVersion": version,
        "uid": stage.uid, "paramMap": values(stage._paramMap), "defaultParamMap": values(stage._defaultParamMap), **more,
    }
    return json.dumps(about)


_OF_TREES = ("featuresCol", "labelCol", "predictionCol", "maxDepth", "minInstancesPerNode", "maxBins", "maxMemoryInMB",
             "cacheNodeIds", "checkpointInterval", "seed", "impurity", "leafCol", "minInfoGain", "minWeightFractionPerNode")


@dataclass
class Grower:
    """Fits what a Spark ML estimator describes."""

    estimator: object
    fits_at_once: int = 1

    def fit(self, prepared: DataFrame) -> Fitted:
        e, spark = self.estimator, prepared.sparkSession
        boosted = isinstance(e, GBTRegressor)
        trees = e.getMaxIter() if boosted else e.getNumTrees()
        rows = prepared.select(vector_to_array(e.getFeaturesCol()).alias("x"), F.col(e.getLabelCol()).alias("y"))
        seed = e.getSeed() & (2**63 - 1)
        cuts, n = fit_bins(rows, e.getMaxBins())
        shape = dict(
            columns=len(cuts), bins=max(2, *(len(c) + 1 for c in cuts)), depth=e.getMaxDepth(), min_leaf=e.getMinInstancesPerNode(),
            subset=columns_per_node(e.getFeatureSubsetStrategy(), len(cuts), trees),
        )
        packed = pack(rows, cuts)
        if boosted:
            nodes = boost(packed, n, cuts, shape, trees, e.getStepSize(), e.getSubsamplingRate(), seed, ALONE * self.fits_at_once)
        else:
            nodes = forest(packed, cuts, shape, trees, seed)
        weights = [1.0 if i == 0 or not boosted else e.getStepSize() for i in range(trees)]
        return Fitted(e, spark, nodes, len(cuts), weights)


class Fitted:
    """Trees to predict with, in ``grown``, and Spark ML's model as soon as anything else is asked for."""

    def __init__(self, estimator, spark: SparkSession, nodes: DataFrame, columns: int, weights: list[float]) -> None:
        self.estimator, self.spark, self.columns, self.weights = estimator, spark, columns, weights
        self.path = f"{checkpoint_folder(spark)}/trees-{uuid.uuid4().hex}"
        nodes.write.parquet(f"{self.path}/data")
        weakref.finalize(self, _remove, spark, self.path).atexit = False
        boosted = isinstance(estimator, GBTRegressor)
        self.grown = read_trees(spark, self.path, weights if boosted else [1 / len(weights)] * len(weights))

    def __getattr__(self, name: str):
        if name.startswith("__") or "path" not in vars(self):
            raise AttributeError(name)
        return getattr(self.model, name)

    @cached_property
    def model(self):
        """Spark ML's model, by way of its own storage."""
        e, spark, version = self.estimator, self.spark, self.spark.version
        kind = GBTRegressionModel if isinstance(e, GBTRegressor) else RandomForestRegressionModel
        about = _record(e, kind.__name__, version, numFeatures=self.columns, numTrees=len(self.weights))
        tree = e.copy()
        for params in (tree._paramMap, tree._defaultParamMap):
            for p in [p for p in params if p.name not in _OF_TREES]:
                del params[p]
        one = _record(tree, "DecisionTreeRegressionModel", version)
        parts = [(i, one.replace(e.uid, f"dtr_{uuid.uuid4().hex[:12]}"), w) for i, w in enumerate(self.weights)]
        spark.createDataFrame([(about,)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/metadata")
        spark.createDataFrame(parts, "_1 int, _2 string, _3 double").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/treesMetadata")
        return kind.load(self.path)
