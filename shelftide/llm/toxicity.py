"""Toxicity by a chain of linear classifiers.

Categories are predicted one after another. The model of a category sees word features and the probabilities of the
categories before it; in training those are out-of-fold predictions, so a later model learns from probabilities as they
come out for unseen texts. The default chain is junk (labelled quality 0), then toxic: junk text looks like many things.

Models are fitted on at most ``SAMPLE`` labelled documents, equal parts of each combination of labels and more of the frequent
ones where rare ones have fewer, drawn by the hash of their ids and weighted back to what they stand for. Features are words, and word beginnings of 4, 5 and 6 letters, so that
inflected forms count together; a model keeps those whose log-odds are beyond ``LEAST_Z`` deviations from zero, the
``FEATURES`` most certain at most. All documents are scored.

Null and empty texts have no words: they get the probabilities of a text without any known feature. Null labels are not
trained on. Repeated rows are scored alike. An empty table gives an empty result; without labelled rows of both kinds a
category's probability is the share of its positive rows, or 0.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 6000
FOLDS = 3
FEATURES = 4000
LEAST_Z = 4.0
LEAST_DOCS = 4
RIDGE = 1e-3
STEPS = 150
#: Words that a worker remembers; it starts anew when full.
REMEMBERED = 500_000

#: Category and the test that makes a labelled row positive.
CATEGORIES: dict[str, str] = {"junk": "quality = 0", "toxic": "toxic = 1"}

_word = re.compile(r"\w+")


def _key(feature: str) -> int:
    return xxhash.xxh64_intdigest(feature) >> 1


def word_features(word: str) -> list[int]:
    """Keys of a lower-case word and of its beginnings."""
    return [_key(word), *(_key(f"{word[:k]}-") for k in (4, 5, 6) if len(word) >= k)]


def shape_features(text: str, words: list[str]) -> list[int]:
    """Keys of: tenths of capital words, of different words, and whether marks are many; length by powers of two."""
    n = max(len(words), 1)
    some = max(sum(map(len, words)), 1)
    capitals = sum(map(str.isupper, words))
    marks = sum(map(text.count, "!#*$%&|<>"))
    return [_key(f) for f in (
        f"capitals:{10 * capitals // n}", f"different:{10 * len(set(words)) // n}", f"marks:{min(9, 40 * marks // some)}", f"long:{len(words).bit_length()}")]


def features(text: str | None) -> np.ndarray:
    """The keys of all features of a text, each once."""
    text = text or ""
    words = _word.findall(text)
    found = set(shape_features(text, words))
    for w in {w.lower() for w in words}:
        found.update(word_features(w))
    return np.sort(np.fromiter(found, np.int64, len(found)))


@dataclass
class Linear:
    """A logistic model over features by key and the probabilities of earlier categories."""

    weights: dict[int, float]
    earlier: list[float]
    intercept: float

    def logit(self, present: list[int], earlier: list[float]) -> float:
        return self.intercept + sum(self.weights.get(f, 0.0) for f in present) + float(np.dot(self.earlier, earlier))


@dataclass
class _Sets:
    """Features of several texts: places in ``keys``, one text after another."""

    keys: np.ndarray
    flat: np.ndarray
    of: np.ndarray
    n: int

    def only(self, keep: np.ndarray) -> _Sets:
        own = keep[self.of]
        return _Sets(self.keys, self.flat[own], (np.cumsum(keep) - 1)[self.of[own]], int(keep.sum()))


def _gathered(texts: list[str]) -> _Sets:
    found = [features(t) for t in texts]
    ranked = np.concatenate([np.zeros(0, np.int64), *found])
    ranked.sort()
    first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])[: len(ranked)])
    keys = ranked[first][np.diff(np.append(first, len(ranked))) >= LEAST_DOCS]
    del ranked
    flat, of = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    for row, f in enumerate(found):
        place = np.searchsorted(keys, f)
        own = place[np.append(keys, -1)[place] == f] if len(keys) else place[:0]
        flat.append(own.astype(np.int32))
        of.append(np.full(len(own), row, np.int32))
    return _Sets(keys, np.concatenate(flat), np.concatenate(of), len(texts))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _chosen(sets: _Sets, y: np.ndarray) -> np.ndarray:
    """Features whose log-odds are clearly not zero, the most certain first."""
    pos, neg = (np.bincount(sets.flat, (y[sets.of] == k).astype(float), minlength=len(sets.keys)) for k in (1, 0))
    a, b = max((y == 1).sum(), 1), max((y == 0).sum(), 1)
    odds = np.log((pos + 0.5) / (a - pos + 0.5)) - np.log((neg + 0.5) / (b - neg + 0.5))
    z = np.abs(odds) / np.sqrt(1 / (pos + 0.5) + 1 / (neg + 0.5) + 1 / (a - pos + 0.5) + 1 / (b - neg + 0.5))
    good = np.flatnonzero((pos + neg >= LEAST_DOCS) & (z >= LEAST_Z))
    return good[np.argsort(-z[good], kind="stable")][:FEATURES]


def fit_linear(sets: _Sets, earlier: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Linear:
    share = float(np.average(y, weights=weight)) if len(y) else 0.0
    if not 0 < share < 1:
        return Linear({}, [0.0] * earlier.shape[1], 30.0 if share == 1 else -30.0)
    chosen = _chosen(sets, y)
    place = np.full(len(sets.keys), -1)
    place[chosen] = np.arange(len(chosen))
    flat = place[sets.flat]
    of = sets.of[flat >= 0]
    flat = flat[flat >= 0]
    d, n = len(chosen), len(y)
    extra = np.column_stack([earlier, np.ones(n)])
    w, v = np.zeros(d), np.zeros(extra.shape[1])
    v[-1] = np.log(share / (1 - share))
    mass = weight / weight.sum()
    seen_w, seen_v = np.full(d, 1e-8), np.full(len(v), 1e-8)
    for _ in range(STEPS):  # gradient steps, each weight at its own pace
        error = mass * (_sigmoid(np.bincount(of, w[flat], minlength=n) + extra @ v) - y)
        gw, gv = np.bincount(flat, error[of], minlength=d) + RIDGE * w / max(d, 1), extra.T @ error
        seen_w += gw * gw
        seen_v += gv * gv
        w -= 0.5 * gw / np.sqrt(seen_w)
        v -= 0.5 * gv / np.sqrt(seen_v)
    return Linear({int(sets.keys[c]): float(x) for c, x in zip(chosen, w, strict=True)}, v[:-1].tolist(), float(v[-1]))


def _predict(model: Linear, sets: _Sets, earlier: np.ndarray) -> np.ndarray:
    w = np.fromiter((model.weights.get(int(k), 0.0) for k in sets.keys), float, len(sets.keys))
    return _sigmoid(np.bincount(sets.of, w[sets.flat], minlength=sets.n) + earlier @ np.array(model.earlier) + model.intercept)


def fit_chain(texts: list[str], labels: np.ndarray, weight: np.ndarray, folds: int = FOLDS) -> list[Linear]:
    """One model per column of ``labels`` (1, 0, or nan where unknown), in order."""
    sets = _gathered(texts)
    fold = np.arange(len(texts)) % folds
    earlier = np.zeros((len(texts), 0))
    models = []
    for c in range(labels.shape[1]):
        y, known = labels[:, c], ~np.isnan(labels[:, c])
        models.append(fit_linear(sets.only(known), earlier[known], y[known], weight[known]))
        if c + 1 < labels.shape[1]:
            out = np.zeros(len(texts))
            for k in range(folds):
                train = known & (fold != k)
                part = fit_linear(sets.only(train), earlier[train], y[train], weight[train])
                out[fold == k] = _predict(part, sets.only(fold == k), earlier[fold == k])
            earlier = np.column_stack([earlier, out])
    return models


def places(sizes: dict[str, int], size: int) -> dict[str, int]:
    """How many rows each stratum gives to a sample of ``size``: equal parts, and what small strata leave goes to larger ones."""
    out, left = {}, size
    for k, (stratum, n) in enumerate(sorted(sizes.items(), key=lambda x: (x[1], x[0]))):
        out[stratum] = min(n, left // (len(sizes) - k))
        left -= out[stratum]
    return out


def training_sample(docs: DataFrame, labels: DataFrame, categories: dict[str, str], size: int = SAMPLE) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Texts, labels and weights of at most ``size`` labelled documents."""
    flags = [F.expr(test).cast("double").alias(f"__{k}") for k, test in categories.items()]
    marked = labels.filter(F.col("doc_id").isNotNull()).select("doc_id", *flags)
    stratum = F.concat_ws("", *[F.coalesce(F.col(f"__{k}").cast("int").cast("string"), F.lit("-")) for k in categories])
    marked = marked.withColumn("__stratum", stratum)
    sizes = {r[0]: r[1] for r in marked.groupBy("__stratum").count().collect()}
    drawn = None
    for s, each in sorted(places(sizes, size).items()):
        part = marked.filter(F.col("__stratum") == s).orderBy(F.xxhash64("doc_id"), "doc_id").limit(each)
        drawn = part if drawn is None else drawn.union(part)
    if drawn is None:
        return [], np.zeros((0, len(categories))), np.zeros(0)
    rows = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").orderBy(F.xxhash64("doc_id"), F.xxhash64("text")).limit(size).collect()
    taken = Counter(r["__stratum"] for r in rows)
    weight = np.array([sizes[r["__stratum"]] / taken[r["__stratum"]] for r in rows])
    flagged = np.array([[np.nan if r[f"__{k}"] is None else r[f"__{k}"] for k in categories] for r in rows]).reshape(-1, len(categories))
    return [r["text"] or "" for r in rows], flagged, weight


class Scorer:
    """Probabilities of all categories for one text after another; a word's weights are looked up once."""

    def __init__(self, models: list[Linear]):
        self.models = models
        self.names = set().union(*(m.weights for m in models))
        self.known: dict[str, tuple[int, ...]] = {}

    def __call__(self, text: str | None) -> list[float]:
        text = text or ""
        words = _word.findall(text)
        if len(self.known) > REMEMBERED:
            self.known = {}
        present = {f for f in shape_features(text, words) if f in self.names}
        for w in set(words):
            if (hit := self.known.get(w)) is None:
                hit = self.known[w] = tuple(f for f in word_features(w.lower()) if f in self.names)
            if hit:
                present.update(hit)
        out: list[float] = []
        for m in self.models:
            out.append(float(_sigmoid(m.logit(sorted(present), out))))
        return out


def score(docs: DataFrame, models: list[Linear], names: list[str]) -> DataFrame:
    """``doc_id`` and a probability per category for every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(models)
        for b in batches:
            found = np.array([scorer(t.as_py()) for t in b.column(1)]).reshape(-1, len(models))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(found[:, k]) for k in range(len(models)))], ["doc_id", *names])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{n} double" for n in names))


def toxicity(docs: DataFrame, labels: DataFrame, categories: dict[str, str] | None = None, size: int = SAMPLE) -> DataFrame:
    """Fits the chain on ``labels`` and scores all of ``docs``: columns ``doc_id`` and one per category."""
    categories = categories or CATEGORIES
    models = fit_chain(*training_sample(docs, labels, categories, size))
    return score(docs, models, list(categories))
