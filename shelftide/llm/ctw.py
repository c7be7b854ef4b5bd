"""Language-model scoring by context-tree weighting over bytes, with a smoothed word model beside it.

Text is lower-cased (A-Z), cut into words, and coded as its words with one space between and one newline as end. Each byte is
eight binary decisions; a decision's context is the bits of the byte so far and up to ``DEPTH`` bytes before it. Every node of
the context tree has a Krichevsky-Trofimov estimate from the training texts and a weight: the posterior that the tree
ends there, against the product of what its longer contexts say. A decision's probability mixes the estimates of all depths
by these weights. Contexts that training has not seen leave their share to the longest one that it has.

Counts are exact and cover all training texts: byte strings of ``DEPTH + 1`` are counted by aggregation, and trees are weighted in
parallel by the last two bytes of their contexts. The strings to be scored are dealt out the same way, so each meets all nodes of
its contexts there, and no node is dropped. The two shallowest depths, which all strings share, go to the tasks. Strings with at
least one in ``FREQUENT_STRINGS`` of all strings and words with at least one in ``FREQUENT`` of all tokens, so at most that many,
are looked up in tables; the rest are joined by key. Both ways give the same values.

Null text is empty: its only token is the end. A null id counts as empty text for the split. Repeated rows are learned from
and scored as often as they occur. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stored

DEPTH = 5
FREQUENT = 1_000_000
FREQUENT_STRINGS = 1 << 22
HELD_OUT, PARTS = 1, 5
#: Bytes of text at a time, and strings and words that a worker holds.
_CHUNK = 1 << 21
_FLUSH = 1_500_000
_SCORED = 200_000
_REMEMBERED = 300_000
_END = b"\n"


def coded(text: bytes | None) -> tuple[list[bytes], bytes]:
    """The words of a text, and the bytes that are scored."""
    words = (text or b"").lower().split()
    return words, b" ".join(words) + _END


def word_key(word: bytes) -> int:
    h = xxhash.xxh64_intdigest(word)
    return h - (1 << 64) if h >> 63 else h


def held_out(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % PARTS == HELD_OUT


def grams(coded_texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The strings of ``depth`` context bytes and one more, as numbers, of all texts; and where each text begins in them."""
    buffer = np.frombuffer(b"".join(_END * depth + t for t in coded_texts), np.uint8)
    sizes = np.array([len(t) for t in coded_texts])
    begins = np.cumsum(sizes) - sizes
    whole = np.zeros(len(buffer) - depth, np.uint64)
    for k in range(depth + 1):
        whole = whole << np.uint64(8) | buffer[k:len(buffer) - depth + k]
    own = np.arange(sizes.sum()) + np.repeat(np.arange(len(sizes)) * depth, sizes)
    return whole[own], begins


def _chunks(batches: Iterator[pa.RecordBatch], text_column: int) -> Iterator[tuple[pa.RecordBatch, list[int], list[tuple[list[bytes], bytes]]]]:
    """Rows of each batch, some megabytes of text at a time."""
    for b in batches:
        rows, texts, size = [], [], 0
        for row, raw in enumerate(b.column(text_column).cast(pa.large_binary())):
            texts.append(coded(raw.as_py()))
            rows.append(row)
            size += len(texts[-1][1])
            if size >= _CHUNK:
                yield b, rows, texts
                rows, texts, size = [], [], 0
        if rows:
            yield b, rows, texts


def corpus_counts(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``(kind, key, n)``: of byte strings (0) and of words by hash, the end included (1), over ``docs``.

    Where a column ``learn`` is false, a text only gives byte strings to be scored (2).
    """
    def out(kind: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))], ["kind", "key", "n"])

    def words_out(words: Counter) -> pa.RecordBatch:
        return out(1, np.fromiter(map(word_key, words), np.int64, len(words)), np.fromiter(words.values(), np.int64, len(words)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {0: [], 2: []}
        words: Counter = Counter()

        def merged(kind: int) -> tuple[np.ndarray, np.ndarray]:
            keys, inverse = np.unique(np.concatenate([np.zeros(0, np.uint64), *(k for k, _ in held[kind])]), return_inverse=True)
            return keys, np.bincount(inverse, np.concatenate([np.zeros(0), *(n for _, n in held[kind])]), len(keys))

        for b, rows, texts in _chunks(batches, 0):
            learn = b.column(1).to_numpy(zero_copy_only=False)[rows]
            for kind, wanted in ((0, True), (2, False)):
                some = [t for (_, t), x in zip(texts, learn, strict=True) if x == wanted]
                if some:
                    held[kind].append(np.unique(grams(some, depth)[0], return_counts=True))
                if sum(len(k) for k, _ in held[kind]) > 2 * _FLUSH:
                    held[kind] = [merged(kind)]
                    if len(held[kind][0][0]) > _FLUSH:
                        yield out(kind, *held[kind].pop())
            for (w, _), x in zip(texts, learn, strict=True):
                if x:
                    words.update(w)
                    words[_END] += 1
            if len(words) > _REMEMBERED:
                yield words_out(words)
                words = Counter()
        for kind in held:
            yield out(kind, *merged(kind))
        yield words_out(words)

    learn = F.col("learn") if "learn" in docs.columns else F.lit(True)
    return docs.select("text", learn.alias("learn")).mapInArrow(run, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, after moving the argument beyond 8."""
    y = np.array(x, float)
    shift = np.zeros_like(y)
    for _ in range(8):
        low = y < 8
        shift[low] -= np.log(y[low])
        y[low] += 1
    return shift + (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)


def block_log(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return _log_gamma(n0 + 0.5) + _log_gamma(n1 + 0.5) - _log_gamma(n0 + n1 + 1) - math.log(math.pi)


def _mask(context_bytes: int) -> np.uint64:
    return np.uint64((1 << 8 * context_bytes) - 1)


@dataclass
class Level:
    """Nodes of one depth: context and bits so far in one number, counts, log probability of the subtree, weight."""

    node: np.ndarray
    n0: np.ndarray
    n1: np.ndarray
    log_weighted: np.ndarray
    weight: np.ndarray


def _nodes(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    context, byte = keys >> np.uint64(8) << np.uint64(8), keys & np.uint64(255)
    ids, bits = [], []
    for k in range(8):
        ids.append(context | np.uint64(1 << k) | byte >> np.uint64(8 - k))
        bits.append(byte >> np.uint64(7 - k) & np.uint64(1))
    node, inverse = np.unique(np.concatenate(ids), return_inverse=True)
    bit, times = np.concatenate(bits), np.tile(n, 8)
    return node, np.bincount(inverse, times * (bit == 0), len(node)), np.bincount(inverse, times * (bit == 1), len(node))


def _parent(node: np.ndarray, depth: int) -> np.ndarray:
    """The node one context byte shorter than one of ``depth``."""
    return (node >> np.uint64(8) & _mask(depth - 1)) << np.uint64(8) | node & np.uint64(255)


def weighted(node: np.ndarray, n0: np.ndarray, n1: np.ndarray, children: np.ndarray | None) -> Level:
    own = block_log(n0, n1)
    if children is None:
        return Level(node, n0, n1, own, np.ones(len(node)))
    return Level(node, n0, n1, np.logaddexp(own, children) - math.log(2), 1 / (1 + np.exp(np.clip(children - own, -700, 700))))


def weighted_levels(keys: np.ndarray, n: np.ndarray, depth: int, least: int) -> list[Level]:
    """Levels from ``depth`` up to ``least`` for whole groups of contexts."""
    out: list[Level] = []
    for d in range(depth, least - 1, -1):
        keys, inverse = np.unique(keys & _mask(d + 1), return_inverse=True)
        n = np.bincount(inverse, n)
        node, n0, n1 = _nodes(keys, n)
        children = None
        if out:
            children = np.bincount(np.searchsorted(node, _parent(out[-1].node, d + 1)), out[-1].log_weighted, len(node))
        out.append(weighted(node, n0, n1, children))
    return out


def _deep_probability(levels: list[Level], keys: np.ndarray, depth: int) -> np.ndarray:
    """Per string and bit of its last byte, what the nodes of two context bytes and more say of that bit; nan where there are none."""
    byte, out = keys & np.uint64(255), np.empty((len(keys), 8))
    contexts = [(keys >> np.uint64(8) & _mask(d)) << np.uint64(8) for d in range(depth + 1)]
    for k in range(8):
        bits = np.uint64(1 << k) | byte >> np.uint64(8 - k)
        one = byte >> np.uint64(7 - k) & np.uint64(1) == 1
        value, rest, last = np.zeros(len(keys)), np.ones(len(keys)), np.full(len(keys), np.nan)
        alive = np.arange(len(keys))
        for d, level in zip(range(2, depth + 1), reversed(levels), strict=True):
            node = contexts[d][alive] | bits[alive]
            at = np.minimum(np.searchsorted(level.node, node), max(len(level.node) - 1, 0))
            found = level.node[at] == node if len(level.node) else np.zeros(len(node), bool)
            alive, at = alive[found], at[found]
            kt = (np.where(one[alive], level.n1[at], level.n0[at]) + 0.5) / (level.n0[at] + level.n1[at] + 1)
            value[alive] += rest[alive] * level.weight[at] * kt
            rest[alive] *= 1 - level.weight[at]
            last[alive] = kt
        out[:, k] = value + rest * last
    return out


def _deep_rows(strings: DataFrame, depth: int) -> DataFrame:
    """From ``(key, n, times)``, how often a string was learned from and is to be scored: each string to be scored with
    :func:`_deep_probability` in ``deep``, and, where ``deep`` is null, what the one-byte contexts need of the deeper nodes: their
    counts and the sum of their longer contexts' log probabilities.
    """
    kind = pa.list_(pa.float64())
    names = ["key", "times", "n0", "n1", "value", "deep"]

    def made(keys: np.ndarray, n: np.ndarray, times: np.ndarray) -> Iterator[pa.RecordBatch]:
        keys, inverse = np.unique(keys, return_inverse=True)
        n, times = np.bincount(inverse, n), np.bincount(inverse, times)
        levels = weighted_levels(keys[n > 0], n[n > 0], depth, 2)
        asked, times = keys[times > 0], times[times > 0].astype(np.int64)
        for k in range(0, len(asked), _SCORED):
            part = asked[k:k + _SCORED]
            m = len(part)
            flat = pa.array(_deep_probability(levels, part, depth).ravel())
            yield pa.RecordBatch.from_arrays([
                pa.array(part.view(np.int64)), pa.array(times[k:k + _SCORED]), *(pa.nulls(m, pa.float64()) for _ in range(3)),
                pa.ListArray.from_arrays(pa.array(np.arange(0, 8 * m + 1, 8, dtype=np.int32)), flat)], names)
        last = levels[-1]
        node, inverse = np.unique(_parent(last.node, 2), return_inverse=True)
        yield pa.RecordBatch.from_arrays([
            pa.array(node.view(np.int64)), pa.nulls(len(node), pa.int64()),
            *(pa.array(np.bincount(inverse, x, len(node))) for x in (last.n0, last.n1, last.log_weighted)), pa.nulls(len(node), kind)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for b in itertools.chain(batches, (None,)):
            if b is not None and b.num_rows:
                held.append((b.column(1).to_numpy().view(np.uint64), b.column(2).to_numpy(), b.column(3).to_numpy()))
            if not held or b is not None and sum(len(x[0]) for x in held) < 300_000:
                continue
            keys, n, times = (np.concatenate(x) for x in zip(*held, strict=True))
            group = keys >> np.uint64(8) & _mask(2)
            whole = len(keys) if b is None else int(np.searchsorted(group, group[-1]))
            if whole:
                yield from made(keys[:whole], n[:whole], times[:whole])
            held = [(keys[whole:], n[whole:], times[whole:])] if whole < len(keys) else []

    grouped = strings.select(F.shiftrightunsigned("key", 8).bitwiseAND(65535).alias("group"), "key", "n", "times")
    return grouped.repartition("group").sortWithinPartitions("group").mapInArrow(
        run, "key long, times long, n0 double, n1 double, value double, deep array<double>")


class Model:
    """Dense estimates and weights for contexts of no and of one byte; the deeper nodes stay in tables.

    ``counts`` are those learned from, ``rows`` are :func:`_deep_rows` of them.
    """

    def __init__(self, depth: int, shallow: list[Level], counts: DataFrame, rows: DataFrame):
        self.depth, self.counts, self.rows = depth, counts, rows
        self.dense = []
        for d, level in enumerate(shallow):
            kt, weight = np.zeros(256 ** (d + 1)), np.zeros(256 ** (d + 1))
            kt[level.node.astype(np.int64)] = (level.n1 + 0.5) / (level.n0 + level.n1 + 1)
            weight[level.node.astype(np.int64)] = level.weight
            self.dense.append((kt, weight))

    def string_logs(self, rows: DataFrame | None = None) -> DataFrame:
        """``(key, times, log)``: natural logarithm of the probability of the last byte of each string after the ones before."""
        shared = self.rows.sparkSession.sparkContext.broadcast(self.dense)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            dense = shared.value
            for b in batches:
                keys = b.column(0).to_numpy().view(np.uint64)
                deep = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, 8)
                byte, total = keys & np.uint64(255), np.zeros(len(keys))
                for k in range(8):
                    bits = np.uint64(1 << k) | byte >> np.uint64(8 - k)
                    one = byte >> np.uint64(7 - k) & np.uint64(1) == 1
                    p = deep[:, k]
                    for d in (1, 0):
                        kt, weight = (x[(((keys >> np.uint64(8) & _mask(d)) << np.uint64(8)) | bits).astype(np.int64)] for x in dense[d])
                        own = np.where(kt > 0, np.where(one, kt, 1 - kt), np.nan)
                        p = np.where(np.isnan(p), own, weight * own + (1 - weight) * p)
                    total += np.log(np.where(np.isnan(p), 0.5, p))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(total)], ["key", "times", "log"])

        rows = self.rows if rows is None else rows
        return rows.filter("deep IS NOT NULL").select("key", "times", "deep").mapInArrow(run, "key long, times long, log double")

    def log_probability(self, keys: np.ndarray) -> np.ndarray:
        """:meth:`string_logs` of any strings, in their order."""
        different, inverse = np.unique(keys, return_inverse=True)
        spark = self.rows.sparkSession
        asked = spark.createDataFrame(pd.DataFrame({"key": different.view(np.int64)}), "key long").select("key", F.lit(0).cast("long").alias("n"), F.lit(1).cast("long").alias("times"))
        learned = self.counts.filter("kind = 0").select("key", "n", F.lit(0).cast("long").alias("times"))
        got = self.string_logs(_deep_rows(learned.unionByName(asked), self.depth)).toPandas()
        order = np.argsort(got["key"].to_numpy().view(np.uint64))
        return got["log"].to_numpy()[order][inverse]


def build_model(counts: DataFrame, depth: int = DEPTH) -> Model:
    """The model of all strings in ``counts``; one row per one-byte context and bits comes to the driver."""
    strings = counts.filter("kind <> 1").select("key", F.when(F.col("kind") == 0, F.col("n")).otherwise(0).alias("n"), F.col("n").alias("times"))
    rows = stored(_deep_rows(strings, depth))
    near = rows.filter("deep IS NULL").groupBy(F.col("key").alias("node")).agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("value").alias("v")).orderBy("node").toPandas()
    one = weighted(near["node"].to_numpy(np.int64).astype(np.uint64), near["n0"].to_numpy(float), near["n1"].to_numpy(float), near["v"].to_numpy(float))
    root, inverse = np.unique(_parent(one.node, 1), return_inverse=True)
    none = weighted(root, *(np.bincount(inverse, x, len(root)) for x in (one.n0, one.n1, one.log_weighted)))
    return Model(depth, [none, one], counts, rows)


def _often(logs: DataFrame) -> tuple[Column, np.ndarray, np.ndarray]:
    """Which strings are frequent, at most ``FREQUENT_STRINGS``; their keys in order, and their log probabilities."""
    total = logs.agg(F.coalesce(F.sum("times"), F.lit(0))).first()[0]
    frequent = F.col("times") * FREQUENT_STRINGS >= total

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns = [b.column(k).to_numpy().astype(t).tobytes() for k, t in enumerate(("<i8", "<f8"))]
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in columns], ["key", "log"])

    keys, values = [np.zeros(0, np.uint64)], [np.zeros(0)]
    for r in logs.filter(frequent).select("key", "log").mapInArrow(packed, "key binary, log binary").toLocalIterator():
        keys.append(np.frombuffer(r["key"], "<i8").view(np.uint64))
        values.append(np.frombuffer(r["log"], "<f8"))
    whole = np.concatenate(keys)
    order = np.argsort(whole)
    return frequent, whole[order], np.concatenate(values)[order]


class _Keys(dict):
    """Hash of each word, computed once."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > _REMEMBERED:
            self.clear()
        self[word] = h = word_key(word)
        return h


def score(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes``.

    ``counts`` must hold the strings of ``docs``, learned from or not.
    """
    spark = docs.sparkSession
    words = counts.filter("kind = 1").select("key", "n")
    total, different = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    often = words.filter(F.col("n") * FREQUENT >= total).orderBy("key").toPandas()
    floor = math.log10(total + 0.5 * (different + 1))
    logs = stored(model.string_logs())
    often_string, known, known_log = _often(logs)
    shared = spark.sparkContext.broadcast((known, known_log, often["key"].to_numpy(np.int64), often["n"].to_numpy(np.int64)))
    kind = docs.schema["doc_id"].dataType.simpleString()
    depth = model.depth
    names = ["row", "doc_id", "kind", "key", "times", "held_out", "n_tokens", "n_known", "base", "score", "n_bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, known_log, keys, n = shared.value
        worth = np.log10(n + 0.5) - floor
        hash_of = _Keys()

        def rest(kind: int, row: np.ndarray, key: np.ndarray, ids: pa.Array) -> pa.RecordBatch:
            left = pd.DataFrame({"row": row, "key": key.view(np.int64)}).value_counts(sort=False)
            k = len(left)
            return pa.RecordBatch.from_arrays([
                pa.array(left.index.get_level_values(0).to_numpy(np.int64)), pa.nulls(k, ids.type), pa.array(np.full(k, kind, np.int32)),
                pa.array(left.index.get_level_values(1).to_numpy(np.int64)), pa.array(left.to_numpy(np.int64)), pa.nulls(k, pa.bool_()),
                *(pa.nulls(k, t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()))], names)

        for b, rows, texts in _chunks(batches, 2):
            strings, begins = grams([t for _, t in texts], depth)
            codes, different = pd.factorize(strings)
            at = np.minimum(np.searchsorted(known, different), max(len(known) - 1, 0))
            frequent = known[at] == different if len(known) else np.zeros(len(different), bool)
            logs = np.zeros(len(different))
            logs[frequent] = known_log[at[frequent]]
            scores = np.add.reduceat(logs[codes], begins) / math.log(10)
            left = np.flatnonzero(~frequent[codes])
            text_of = np.searchsorted(begins, left, side="right") - 1

            sizes = np.array([len(w) + 1 for w, _ in texts])
            of = np.repeat(np.arange(len(texts)), sizes)
            hashes = np.fromiter(map(hash_of.__getitem__, itertools.chain.from_iterable((*w, _END) for w, _ in texts)), np.int64, sizes.sum())
            at = np.minimum(np.searchsorted(keys, hashes), max(len(keys) - 1, 0))
            common = keys[at] == hashes if len(keys) else np.zeros(len(hashes), bool)
            base = np.bincount(of[common], worth[at[common]], len(texts))
            ids = b.column(1).take(pa.array(rows))
            row = b.column(0).to_numpy()[rows]
            m = len(rows)
            yield pa.RecordBatch.from_arrays([
                pa.array(row), ids, pa.nulls(m, pa.int32()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.array([held_out(i) for i in ids.to_pylist()]), pa.array(sizes),
                pa.array(np.bincount(of[common], minlength=m)), pa.array(base), pa.array(scores), pa.array(np.array([len(t) for _, t in texts]))], names)
            yield rest(0, row[text_of], strings[left], ids)
            yield rest(1, row[of[~common]], hashes[~common], ids)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    found = stored(rows.mapInArrow(run, f"row long, doc_id {kind}, kind int, key long, times long, held_out boolean, n_tokens long, n_known long, base double, score double, n_bytes long"))
    rare = found.filter("n_tokens IS NULL").select("row", "kind", "key", "times")
    values = words.select(F.lit(1).alias("kind"), "key", (F.log10(F.col("n") + 0.5) - floor).alias("value")).unionByName(
        logs.filter(~often_string).select(F.lit(0).alias("kind"), "key", (F.col("log") / math.log(10)).alias("value")))
    missing = F.when(F.col("kind") == 1, math.log10(0.5) - floor).otherwise(F.raise_error(F.lit("a string was not counted")).cast("double"))
    of = lambda kind, v: F.sum(F.when(F.col("kind") == kind, v).otherwise(0))
    worth = F.coalesce("value", missing) * F.col("times")
    more = rare.join(values, ["kind", "key"], "left").groupBy("row").agg(
        of(1, F.when(F.col("value").isNotNull(), F.col("times")).otherwise(0)).alias("more_known"), of(1, worth).alias("more_base"), of(0, worth).alias("more_score"))
    return (
        found.filter("n_tokens IS NOT NULL").join(more, "row", "left")
        .select(
            "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
            (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
            (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"), "n_bytes")
    )


def score_documents(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Learns from the documents that are not held out and scores all."""
    part = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(PARTS))
    counts = stored(corpus_counts(docs.withColumn("learn", part != HELD_OUT), depth))
    return score(docs, build_model(counts, depth), counts)
