"""Exact removal of repeated byte strings, by cuts that follow the content and keys of hashes.

Rolling hashes cut each text into phrases: a phrase ends where the hash of ``GRAM`` bytes is the least among ``WINDOW`` places. The
cut depends on the bytes near it only, so equal strings are cut alike wherever they stand. Every ``length``-byte
string belongs to one cut, so a run of strings is named by what stands right of its cut and by all its bytes from the first
string to the last. Only equality of ``length`` bytes matters, never their order, so no suffix array is built: equal keys of
hashes stand for equal bytes.

A first pass over the texts counts the right sides; a bitmap of those that occur twice lets the second pass give rows for the
other runs only. Runs whose right side occurs once hold no repeated string. Runs that are equal as a whole are repeated as a
whole. What is left are the edges of repeated passages: one run per different content goes to its right side's group, where
all strings of the group are sorted together by their keys, and neighbours with equal keys are repeated.
Groups with more than ``HOT_GROUP`` different contents are counted by key over all tasks instead. Only texts that have edges,
and at the end those that lose bytes, are shuffled.

Null text is empty. Texts shorter than ``length`` bytes lose nothing. Strings are judged on the input; matches do not cross
documents; a repeated row makes all its strings repeated. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored
from .sieve import Sieve, sieve_of

LENGTH = 400
WINDOW = 200
GRAM = 16
HOT_GROUP = 2000
#: Bytes of text, and contents of edges, that a task works on at a time.
_CHUNK = 1 << 18
_CONTENTS = 500

_SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class Hashes:
    """Keys of any stretch of a buffer by prefix sums of ``value[byte] * base ** place``, modulo 2 ** 64."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = np.uint64(int(rng.integers(1 << 40, 1 << 60)) * 8 + 5)
        self.inverse = np.uint64(pow(int(self.base), -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def prepare(self, buffer: np.ndarray) -> None:
        n = len(buffer) + 1
        if len(self.up) < n:
            grown = np.full(n, self.base)
            grown[0] = 1
            self.up = np.multiply.accumulate(grown)
            grown[1:] = self.inverse
            self.down = np.multiply.accumulate(grown)
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(self.values[buffer] * self.up[: n - 1], out=self.sums[1:])

    def key(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x = (self.sums[b] - self.sums[a]) * self.down[a]
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def _least_in_window(keys: np.ndarray, size: int) -> np.ndarray:
    """The least of ``keys[i : i + size]`` for each i; places beyond the end count as large."""
    n = len(keys)
    blocks = np.full((-(-(n + size) // size)) * size, np.iinfo(np.uint64).max, np.uint64)
    blocks[:n] = keys
    rows = blocks.reshape(-1, size)
    before = np.minimum.accumulate(rows, axis=1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[size - 1: size - 1 + n])


def cuts(buffer: np.ndarray, ends: np.ndarray, hashes: Hashes, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """For documents that end at ``ends`` in one buffer: document, first start, cut, last start (all in the buffer), right side's key.

    A run holds the starts of ``length``-byte strings whose cut is the same.
    """
    window = length // 2
    begins = np.append(0, ends[:-1])
    counts = np.maximum(ends - begins - length + 1, 0)
    none = np.zeros(0, np.int64)
    if not counts.any():
        return none, none, none, none, none.view(np.uint64)
    hashes.prepare(buffer)
    place = np.arange(len(buffer))
    gram = hashes.key(place, np.minimum(place + GRAM, len(buffer)))
    # The right one of equal hashes: the low half falls from left to right.
    low = np.uint64(0xFFFFFFFF)
    least = _least_in_window((gram & ~low) | (low - place.astype(np.uint64)), window)
    document = np.repeat(np.arange(len(ends)), counts)
    starts = np.arange(len(document)) - np.repeat(np.cumsum(counts) - counts, counts) + begins[document]
    cut = (low - (least[starts] & low)).astype(np.int64)
    new = np.flatnonzero(np.append(True, (cut[1:] != cut[:-1]) | (document[1:] != document[:-1])))
    last = starts[np.append(new[1:] - 1, len(starts) - 1)]
    cut = cut[new]
    return document[new], starts[new], cut, last, hashes.key(cut, cut + length - window + 1)


def whole_keys(buffer: np.ndarray, first: np.ndarray, cut: np.ndarray, last: np.ndarray, hashes: tuple[Hashes, Hashes], length: int = LENGTH) -> list[np.ndarray]:
    """Two keys of each run's bytes and of where its cut and its last string stand in them; ``hashes[0]`` is prepared already."""
    hashes[1].prepare(buffer)
    mixed = (cut - first).astype(np.uint64) * np.uint64(0x100000001B3) + (last - first).astype(np.uint64)
    return [h.key(first, last + length) ^ mixed * np.uint64(s) for h, s in zip(hashes, _SEEDS, strict=True)]


def _texts(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def _chunks(b: pa.RecordBatch, column: int, length: int) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Texts of at least ``length`` bytes in pieces of some ``_CHUNK`` bytes: rows, buffer, and where each text ends in it."""
    rows, texts, size = [], [], 0
    for row, text in enumerate(_texts(b.column(column))):
        if len(text) >= length:
            rows.append(row)
            texts.append(text)
            size += len(text)
        if size >= _CHUNK:
            yield rows, np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])
            rows, texts, size = [], [], 0
    if rows:
        yield rows, np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])


def _right_sides(docs: DataFrame, length: int) -> DataFrame:
    """``(k1, n)``: keys of right sides and how often they occur, added up per piece of text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes(_SEEDS[0])
        for b in batches:
            for _, buffer, ends in _chunks(b, 0, length):
                k1, n = np.unique(cuts(buffer, ends, hashes, length)[4].view(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(k1), pa.array(n)], ["k1", "n"])

    return docs.select("text").mapInArrow(run, "k1 long, n long")


def parsed(docs: DataFrame, wanted: Sieve, length: int = LENGTH) -> DataFrame:
    """One row per run of every document whose right side is in ``wanted``: where it stands in it, and its keys."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "text_key", "first", "last", "k1", "ka", "kb"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = (Hashes(_SEEDS[0]), Hashes(_SEEDS[1]))
        for b in batches:
            for rows, buffer, ends in _chunks(b, 2, length):
                document, first, cut, last, right = cuts(buffer, ends, hashes[0], length)
                k1 = right.view(np.int64)
                held = np.flatnonzero(wanted.may_hold(k1))
                if not len(held):
                    continue
                document, first, cut, last, k1 = (x[held] for x in (document, first, cut, last, k1))
                ka, kb = whole_keys(buffer, first, cut, last, hashes, length)
                begins = np.append(0, ends[:-1])[document]
                at = pa.array(np.array(rows, np.int64)[document])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(at), b.column(1).take(at), *(pa.array(x) for x in (first - begins, last - begins, k1, ka.view(np.int64), kb.view(np.int64)))], names)

    return docs.select("doc_id", "text_key", "text").mapInArrow(
        run, f"doc_id {kind}, text_key long, first long, last long, k1 long, ka long, kb long")


def _contexts(docs: DataFrame, edges: DataFrame, length: int) -> DataFrame:
    """``(k1, ka, kb, n, bytes)`` of each edge run: its bytes from the first string to the end of the last.

    Rows that are the same in ``docs`` give the same rows here.
    """
    docs = sieve_of(edges.select("text_key")).sift(docs, "text_key")
    wanted = edges.groupBy(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).agg(
        F.collect_list(F.struct("first", "last", "k1", "ka", "kb", "n")).alias("__runs"))
    joined = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["__id"]) & (docs["text_key"] == wanted["__key"]))
    names = ["k1", "ka", "kb", "n", "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, asked in zip(_texts(b.column(0)), b.column(1).to_pylist(), strict=True):
                out += [(r["k1"], r["ka"], r["kb"], r["n"], text[r["first"]:r["last"] + length]) for r in asked]
                if len(out) > 5000:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(),) * 4 + (pa.binary(),), strict=True)], names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(),) * 4 + (pa.binary(),), strict=True)], names)

    return joined.select("text", "__runs").mapInArrow(run, "k1 long, ka long, kb long, n long, bytes binary")


def _suffix_keys(contexts: list[bytes], hashes: tuple[Hashes, Hashes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all suffixes with ``length`` bytes: the context, the start in it, and the two keys of those bytes."""
    sizes = np.array([len(c) for c in contexts])
    counts = sizes - length + 1
    begins = np.cumsum(sizes) - sizes
    for h in hashes:
        h.prepare(np.frombuffer(b"".join(contexts), np.uint8))
    of = np.repeat(np.arange(len(contexts)), counts)
    start = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = begins[of] + start
    return of, start, hashes[0].key(at, at + length), hashes[1].key(at, at + length)


def _spans(of: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive starts in one context: context, first, last."""
    new = np.flatnonzero(np.append(True, (of[1:] != of[:-1]) | (start[1:] != start[:-1] + 1)))
    return of[new], start[new], start[np.append(new[1:] - 1, len(start) - 1)]


_EDGE = "ka long, kb long, from long, to long"


def _group_matches(contexts: DataFrame, length: int) -> DataFrame:
    """Repeated starts of edge runs; each group's suffixes are sorted together in one task."""
    def matched(rows: list[np.ndarray], texts: list[bytes], hashes: tuple[Hashes, Hashes]) -> pa.RecordBatch | None:
        of, start, a, b = _suffix_keys(texts, hashes, length)
        order = np.lexsort((b, a))
        same = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
        found = np.zeros(len(of), bool)
        found[order[1:][same]] = found[order[:-1][same]] = True
        found &= rows[2][of] == 1  # the others are repeated anyway
        if not found.any():
            return None
        c, lo, hi = _spans(of[found], start[found])
        return pa.RecordBatch.from_arrays([pa.array(rows[0][c]), pa.array(rows[1][c]), pa.array(lo), pa.array(hi)], ["ka", "kb", "from", "to"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = (Hashes(_SEEDS[0]), Hashes(_SEEDS[1]))
        k1, rows, texts = np.zeros(0, np.int64), [np.zeros(0, np.int64)] * 3, []
        for b in itertools.chain(batches, (None,)):
            if b is not None:
                k1 = np.append(k1, b.column(0).to_numpy())
                rows = [np.append(r, b.column(k + 1).to_numpy()) for k, r in enumerate(rows)]
                texts += b.column(4).to_pylist()
            whole = len(k1) if b is None else int(np.searchsorted(k1, k1[-1])) if len(k1) else 0
            if whole and (b is None or whole >= _CONTENTS):
                # Pieces of whole groups, so that the suffixes of one piece fit in memory.
                at = 0
                while at < whole:
                    to = min(at + _CONTENTS, whole)
                    to = whole if to == whole else int(np.searchsorted(k1[:whole], k1[to - 1], side="right"))
                    if (out := matched([r[at:to] for r in rows], texts[at:to], hashes)) is not None:
                        yield out
                    at = to
                k1, rows, texts = k1[whole:], [r[whole:] for r in rows], texts[whole:]

    return contexts.repartition("k1").dropDuplicates(["k1", "ka", "kb"]).sortWithinPartitions("k1").select("k1", "ka", "kb", "n", "bytes").mapInArrow(run, _EDGE)


def _counted_matches(contexts: DataFrame, length: int) -> DataFrame:
    """The same for groups too large for one task: their suffixes' keys are counted over all tasks."""
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = (Hashes(_SEEDS[0]), Hashes(_SEEDS[1]))
        for b in batches:
            texts = b.column(3).to_pylist()
            for k in range(0, len(texts), _CONTENTS):
                of, start, x, y = _suffix_keys(texts[k:k + _CONTENTS], hashes, length)
                ka, kb, n = (b.column(c).to_numpy()[k:k + _CONTENTS][of] for c in range(3))
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (ka, kb, n, start, x.view(np.int64), y.view(np.int64))], ["ka", "kb", "n", "at", "x", "y"])

    grams = contexts.dropDuplicates(["k1", "ka", "kb"]).select("ka", "kb", "n", "bytes").mapInArrow(keys, "ka long, kb long, n long, at long, x long, y long")
    often = grams.groupBy("x", "y").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    found = grams.filter("n = 1").join(often, ["x", "y"]).select("ka", "kb", F.col("at").alias("from"), F.col("at").alias("to"))
    return found


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(doc_id, text_key, spans)``: per document the byte spans ``(from, to)`` to remove, possibly overlapping.

    ``docs`` has doc_id, text_key and text.
    """
    twice = stored(_right_sides(docs, length).groupBy("k1").agg(F.sum("n").alias("n")).filter("n > 1").select("k1"))
    # Runs that the bitmap holds by chance stand alone below and drop out there.
    repeated = stored(parsed(docs, sieve_of(twice), length))
    place = F.struct("doc_id", "text_key", "first", "last")
    contents = stored(repeated.groupBy("k1", "ka", "kb").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("p")))
    groups = contents.groupBy("k1").agg(F.count(F.lit(1)).alias("c"), F.min("n").alias("least")).filter("c > 1 AND least = 1")
    edges = stored(contents.join(groups, "k1").select("k1", "ka", "kb", "n", "p.*", "c"))
    contexts = stored(_contexts(docs, edges.filter(F.col("c") <= HOT_GROUP).drop("c"), length))
    matches = _group_matches(contexts, length)
    hot = edges.filter(F.col("c") > HOT_GROUP)
    if not hot.isEmpty():
        matches = matches.union(_counted_matches(stored(_contexts(docs, hot.drop("c"), length)), length))
    whole = (
        repeated.join(contents.filter("n > 1").select("k1", "ka", "kb"), ["k1", "ka", "kb"])
        .select("doc_id", "text_key", F.col("first").alias("from"), (F.col("last") + length).alias("to"))
    )
    # An edge run stands once, so its content's place is the run itself.
    part = edges.filter("n = 1").join(matches, ["ka", "kb"]).select(
        "doc_id", "text_key", (F.col("first") + F.col("from")).alias("from"), (F.col("first") + F.col("to") + length).alias("to"))
    return whole.union(part).groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("from", "to")).alias("spans"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by the spans."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept`` (bytes) and ``kept_sha256``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    spans = stored(repeated_spans(keyed, length)).withColumnsRenamed({"doc_id": "__id", "text_key": "__key", "spans": "__spans"})
    losing = sieve_of(spans.select("__key"))
    touched = losing.sift(keyed, "text_key").alias("d").join(
        spans, F.col("d.doc_id").eqNullSafe(spans["__id"]) & (F.col("d.text_key") == spans["__key"]), "left").select("doc_id", "text", "__spans")
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"]

    def cut_out(ids: pa.Array, texts: list[bytes], spans: Iterable[list[dict] | None]) -> pa.RecordBatch:
        rows = []
        for text, of in zip(texts, spans, strict=False):
            gone = merged([(s["from"], s["to"]) for s in of or ()])
            at, kept = 0, []
            for x, y in gone:
                kept.append(text[at:x])
                at = y
            left = b"".join([*kept, text[at:]]) if gone else text
            rows.append((len(text), len(text) - len(left), len(gone), left, hashlib.sha256(left).hexdigest()))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
        return pa.RecordBatch.from_arrays([ids, *(pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds))], names)

    def cut_touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield cut_out(b.column(0), _texts(b.column(1)), b.column(2).to_pylist())

    def pass_others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(losing.tested(b.column(2), inside=False))
            yield cut_out(b.column(0), _texts(b.column(1)), itertools.repeat(None))

    made = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"
    return touched.mapInArrow(cut_touched, made).union(keyed.select("doc_id", "text", "text_key").mapInArrow(pass_others, made))
