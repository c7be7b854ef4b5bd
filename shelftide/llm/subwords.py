"""Quality classifier on supervised subword embeddings.

A document is the mean of the vectors of its tokens: words, character n-grams of ``GRAMS`` bytes that stay inside a word with its
border on either side, and pairs of neighbouring words, all hashed into ``BUCKETS`` buckets. A softmax layer on that mean gives
the probability of each label; vectors and layer are learned together by stochastic gradient descent in numpy. A pair is the
exclusive or of its words' hashes, so a word said twice in a row falls into one bucket whatever the word.

The fit uses at most ``SAMPLE`` labelled documents, drawn by the hash of their ids, in shares as they are labelled; their tokens
are counted in Spark tasks, so the driver sees counts by bucket and no texts. Documents are scored in Spark tasks: the softmax
of a mean is linear in its tokens, so the model goes to them as one number per bucket (``BUCKETS`` floats).

Only the text is an input. Null and empty texts have no tokens and get the score of the layer's offset. Null labels and ids are
not trained on. Repeated rows are scored alike. Texts of any length are read whole, in slices of ``SLICE`` bytes that are cut
between words; pairs across a cut do not count, and a word longer than a slice counts as several. Without labelled rows of both kinds the score is the share of
label 1, or 0.5 if there is none. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 6000
BUCKETS = 1 << 17
DIMENSIONS = 8
GRAMS = (2, 3, 4)
EPOCHS = 6
RATE = 0.5
#: Steps of the offset and of the vectors, in units of the layer's.
OFFSET_RATE = 0.02
VECTOR_RATE = 1.0
SEED = 12
SLICE = 1 << 20

_MIX = np.uint64(0xBF58476D1CE4E5B9)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A finisher that spreads 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def _bucket(x: np.ndarray, kind: int) -> np.ndarray:
    apart = np.uint64(kind * int(_STEP) % 2**64)
    return (_mixed(x + apart) & np.uint64(BUCKETS - 1)).astype(np.int32)


def _tokens(raw: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and buckets of all tokens in bytes that begin and end with a space; ``texts`` are the places where texts begin."""
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    wide = np.where(space, np.uint8(32), raw).astype(np.uint64) + np.uint64(1)
    places, buckets = [], []
    # n-grams from each byte, unless a space is inside; a space may be first or last, but not all of it.
    rolling = wide * _STEP
    blocked = np.zeros(len(raw), bool)
    for n in range(2, max(GRAMS) + 1):
        if len(raw) < n:
            break
        m = len(raw) - n + 1
        rolling = _mixed(rolling[:m]) + wide[n - 1:] * _STEP
        blocked = space[:m] & space[1:] if n == 2 else (blocked[:m] if n > 3 else np.zeros(m, bool)) | space[n - 2: n - 2 + m]
        if n in GRAMS:
            at = np.flatnonzero(~blocked)
            places.append(at)
            buckets.append(_bucket(rolling[at], n))
    starts = np.flatnonzero(~space[1:] & space[:-1]) + 1
    if len(starts):
        inside = np.flatnonzero(~space)
        first = np.searchsorted(inside, starts)
        letter = np.arange(len(inside)) - np.repeat(first, np.diff(np.append(first, len(inside))))
        hashes = _mixed(np.add.reduceat(wide[inside] * _mixed(letter.astype(np.uint64) + _STEP), first))
        text = np.searchsorted(texts, starts, "right")
        pair = np.flatnonzero(text[1:] == text[:-1])
        places += [starts, starts[pair]]
        buckets += [_bucket(hashes, 0), _bucket(hashes[pair + 1] ^ hashes[pair], 1)]
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    return np.concatenate(places), np.concatenate(buckets)


class Reader:
    """Tokens of a column of texts, slice by slice."""

    def __init__(self, texts: pa.Array):
        whole, none, gap = texts.cast(pa.large_string()), pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
        padded = pc.binary_join_element_wise(none, pc.fill_null(whole, none), none, gap)
        self.n = len(padded)
        self.ends = np.frombuffer(padded.buffers()[1], np.int64)[padded.offset: padded.offset + self.n + 1] if self.n else np.zeros(1, np.int64)
        data = padded.buffers()[2]
        self.raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)

    def _cut(self, begin: int, end: int) -> int:
        """Where a slice that begins at ``begin`` ends: at ``end`` if that is near, else after the last space, if there is one."""
        if end - begin <= SLICE:
            return end
        window = self.raw[begin: begin + SLICE]
        gaps = np.flatnonzero((window == 32) | ((window >= 9) & (window <= 13)))
        return begin + (int(gaps[-1]) + 1 if len(gaps) else SLICE)

    def __iter__(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows and buckets of tokens. Short texts share a slice, a long one has slices of its own."""
        edge, row = np.full(1, 32, np.uint8), 0
        while row < self.n:
            begin = int(self.ends[row])
            last = max(int(np.searchsorted(self.ends, begin + SLICE, "right")) - 1, row + 1)
            stop = int(self.ends[last])
            while begin < stop:
                end = self._cut(begin, stop)
                at, bucket = _tokens(np.concatenate([edge, self.raw[begin:end], edge]), self.ends[row:last] - begin + 1)
                own = np.searchsorted(self.ends[row:last + 1] - begin + 1, np.maximum(at, 1), "right") - 1 + row
                yield np.minimum(own, last - 1), bucket
                begin = end
            row = last


@dataclass
class Model:
    """Vectors of buckets and the softmax layer."""

    vectors: np.ndarray
    layer: np.ndarray
    offset: np.ndarray

    def margins(self) -> tuple[np.ndarray, float]:
        """What a token adds to the logit of label 1, before averaging, and the offset."""
        return self.vectors @ (self.layer[:, 1] - self.layer[:, 0]), float(self.offset[1] - self.offset[0])


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def fit(documents: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, seed: int = SEED) -> Model:
    """Learns from (buckets, counts, label) of documents, one at a time in a random order."""
    rng = np.random.default_rng(seed)
    model = Model(
        rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS, np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32))
    ones = sum(label for *_, label in documents)
    if not 0 < ones < len(documents):
        share = ones / len(documents) if documents else 0.5
        model.vectors[:] = 0
        model.offset[1] = np.clip(np.log(share / (1 - share)) if 0 < share < 1 else 60 * share - 30, -30, 30)
        return model
    steps, done = epochs * len(documents), 0
    for _ in range(epochs):
        for k in rng.permutation(len(documents)):
            buckets, counts, label = documents[k]
            rate = RATE * (1 - done / steps)
            done += 1
            weight = (counts / max(counts.sum(), 1)).astype(np.float32)
            mean = weight @ model.vectors[buckets]
            error = _softmax(mean @ model.layer + model.offset).astype(np.float32)
            error[label] -= 1
            back = model.layer @ error
            model.layer -= rate * np.outer(mean, error)
            model.offset -= rate * OFFSET_RATE * error
            # A token's share of a document is small; in units of the mean share its step keeps its size in long texts.
            model.vectors[buckets] -= rate * VECTOR_RATE * np.outer(weight * min(len(buckets), 1000), back)
    return model


_COUNTED = "label int, buckets binary, counts binary"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, label) to the label and the counts by bucket of each text."""
    for batch in batches:
        for k in range(batch.num_rows):
            total = np.zeros(BUCKETS, np.int32)
            for _, bucket in Reader(batch.column(0)[k:k + 1] if batch.num_rows > 1 else batch.column(0)):
                total += np.bincount(bucket, minlength=BUCKETS).astype(np.int32)
            found = np.flatnonzero(total).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1)[k:k + 1].cast(pa.int32()), pa.array([found.tobytes()]), pa.array([total[found].tobytes()])], ["label", "buckets", "counts"])


def training_counts(docs: DataFrame, labels: DataFrame, train: Column, size: int = SAMPLE) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Counts by bucket and labels of at most ``size`` labelled documents that ``train`` holds for."""
    marked = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & train).select("doc_id", F.col("quality").alias("__label"))
    drawn = marked.orderBy(F.xxhash64("doc_id"), "doc_id", "__label").limit(size)
    rows = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    rows = rows.orderBy(F.xxhash64("doc_id"), F.xxhash64("text"), "__label").limit(size).select("text", "__label")
    found = rows.repartition(rows.sparkSession.sparkContext.defaultParallelism, F.xxhash64("text")).mapInArrow(_counted, _COUNTED).collect()
    documents = [(np.frombuffer(r["buckets"], np.int32), np.frombuffer(r["counts"], np.int32), r["label"]) for r in found]
    # One order whatever the tasks' order was.
    return sorted(documents, key=lambda d: (d[2], len(d[0]), d[0].tobytes(), d[1].tobytes()))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and the probability of label 1 for every document."""
    margins, offset = model.margins()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums, n = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            for row, bucket in Reader(batch.column(1)):
                sums += np.bincount(row, margins[bucket], minlength=batch.num_rows)
                n += np.bincount(row, minlength=batch.num_rows)
            found = 1 / (1 + np.exp(-np.clip(offset + sums / np.maximum(n, 1), -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def classify(docs: DataFrame, labels: DataFrame, train: Column | None = None, size: int = SAMPLE) -> DataFrame:
    """Fits on ``labels`` where ``train`` (an expression of ``doc_id``, all by default) holds and scores all of ``docs``."""
    return score(docs, fit(training_counts(docs, labels, F.lit(True) if train is None else train, size)))
