"""Benchmark decontamination by edit distance.

Texts are lists of lower-case words (``\\w+``). A document is contaminated by an item when some passage of it is within
``edits * words`` word edits of the item. Candidates come from the CGK embedding: a random walk over the words, which steps on
or stays by a random bit of (step, word), turns edit distance into Hamming distance of the walks. Sampled steps of a walk
are keys of a hash table; ``SAMPLES`` samples of each of several walks are tried. Windows are as long as the shorter half of
the items they stand for: items are sorted into classes by length, documents are cut into windows side by side, and the
table holds the walk of the item from each of its words, so whatever the alignment, some window begins inside the passage at a
word of the item. The number of walks of a class is the least that finds ``RECALL`` of its items with the most edits allowed,
planted into random text. A class that ``MOST_WALKS`` walks do not bring there is looked up exactly instead: an item is cut into
one piece more than it may have edits, so some piece stands in the passage unchanged. Every candidate is settled by the exact
edit distance between the item and the best passage (Myers).

Items come to the tasks in blocks of at most ``BLOCK_CHARS`` characters, each against all documents.

Null and empty texts have no words and no hits; items without a word match nothing. Repeated rows get the same hits. Items with
equal text are each reported. An empty table on either side gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EDITS = 0.2
RECALL = 0.99
SAMPLES = 8
SAMPLED_STEPS = 6
MOST_WALKS = 12
TRIALS = 400
BLOCK_CHARS = 16_000_000
_CHUNK_CHARS = 2_000_000
_FILTER_BITS = 16

_word = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _word.findall((text or "").lower())


def most_edits(words: int, edits: float = EDITS) -> int:
    return int(words * edits + 1e-9)


def passage_distance(item: list, text: list) -> tuple[int, int]:
    """Least edit distance of ``item`` to any passage of ``text``, and the end of the first best passage."""
    n = len(item)
    masks: dict = {}
    for k, x in enumerate(item):
        masks[x] = masks.get(x, 0) | 1 << k
    full, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score, best, end = full, 0, n, n, 0
    for j, x in enumerate(text, 1):
        eq = masks.get(x, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        up, down = (minus | ~(xh | plus)) & full, plus & xh
        score += bool(up & top) - bool(down & top)
        up, down = up << 1 & full, down << 1 & full
        plus, minus = (down | ~(xv | up)) & full, up & xv
        if score < best:
            best, end = score, j
    return best, end


def best_passage(item: list, text: list) -> tuple[int, int, int]:
    """``(distance, start, end)`` of the first best passage, the shortest with that end."""
    distance, end = passage_distance(item, text)
    back = text[:end][::-1]
    # The reversed item must match from the first word on: its best passage that begins there.
    n = len(item)
    row, best = list(range(n + 1)), (n, 0)
    for j, x in enumerate(back[: n + distance], 1):
        new = [j]
        for k, y in enumerate(reversed(item)):
            new.append(min(row[k] + (x != y), row[k + 1] + 1, new[k] + 1))
        row = new
        if row[n] < best[0]:
            best = (row[n], j)
    return distance, end - best[1], end


@dataclass
class _Class:
    """Items of one range of lengths: window, and per walk and sample the steps, keys, and the items' places they mean."""

    window: int
    steps: list[np.ndarray]
    keys: list[list[np.ndarray]]
    places: list[list[np.ndarray]]
    #: In place of walks: per length of pieces their keys, and the items' places they mean.
    pieces: dict[int, tuple[np.ndarray, np.ndarray]] | None = None
    reached: float = 0.0

    def filters(self) -> list[list[np.ndarray]]:
        """Per walk and sample, which leading bits any key has; made where they are used."""
        return [[_leading(key) for key in keys] for keys in self.keys]


def _leading(keys: np.ndarray) -> np.ndarray:
    seen = np.zeros(1 << _FILTER_BITS, bool)
    seen[keys >> np.uint64(64 - _FILTER_BITS)] = True
    return seen


def _looked_up(key: np.ndarray, table: np.ndarray, places: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``key`` and the places of equal keys of the table, one row per pair."""
    good = np.flatnonzero(seen[key >> np.uint64(64 - _FILTER_BITS)])
    lo, hi = np.searchsorted(table, key[good]), np.searchsorted(table, key[good], side="right")
    row = np.repeat(np.arange(len(good)), hi - lo)
    return good[row], places[lo[row] + np.arange(len(row)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo)]


def _key(symbols: list[np.ndarray]) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = np.zeros(len(symbols[0]), np.uint64)
        for s in symbols:
            x = (x ^ s.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(29)
        return x


class Index:
    """The items' walks, ready to be probed with documents."""

    def __init__(self, items: list[tuple[object, list[str]]], edits: float = EDITS, recall: float = RECALL, seed: int = 7):
        self.ids = [i for i, w in items if w]
        self.words = [w for _, w in items if w]
        self.vocabulary: dict[str, int] = {}
        for w in self.words:
            for x in w:
                self.vocabulary.setdefault(x, len(self.vocabulary) + 1)
        self.tokens = [np.array([self.vocabulary[x] for x in w], np.int32) for w in self.words]
        self.edits = edits
        self.by_class: dict[int, list[int]] = {}
        for k, t in enumerate(self.tokens):
            self.by_class.setdefault(len(t).bit_length() - 1, []).append(k)
        self.seed = seed
        self._filters: list | None = None
        self.classes = [self._settled(length, members, recall) for length, members in sorted(self.by_class.items())]

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_filters": None}

    def _settled(self, length: int, members: list[int], recall: float) -> _Class:
        """The class with as many walks as ``recall`` takes, or with pieces."""
        c = _Class(max(1, (1 << length) // 2), [], [], [])
        wanted, flat, starts, sizes = self._trials(length, members, c.window)
        missed = np.ones(len(wanted), bool)
        while len(c.keys) < MOST_WALKS and c.reached < recall:
            self._grow(c, length, members)
            got = self._by_walk(c, length, len(c.keys) - 1, [_leading(k) for k in c.keys[-1]], flat, starts, sizes)
            missed[got[got[:, 1] == wanted[got[:, 0]], 0]] = False
            c.reached = 1 - missed.mean()
        return c if c.reached >= recall else _Class(c.window, [], [], [], self._pieces(members), 1.0)

    def _pieces(self, members: list[int]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        rows: dict[int, list[tuple[int, int]]] = {}
        for k in members:
            n = len(self.tokens[k])
            cuts = most_edits(n, self.edits) + 1
            # Beyond as many pieces as words any passage is near enough; single words are the least.
            for p in range(min(cuts, n)):
                at, end = n * p // min(cuts, n), n * (p + 1) // min(cuts, n)
                rows.setdefault(end - at, []).append((k, at))
        out = {}
        for size, found in rows.items():
            place = np.array(found)
            words = np.array([self.tokens[k][at:at + size] for k, at in found])
            key = _key(list(words.T))
            order = np.argsort(key, kind="stable")
            out[size] = key[order], place[order]
        return out

    def _rng(self, *salt: int) -> np.random.Generator:
        return np.random.default_rng([self.seed, *salt])

    def _bits(self, length: int, walk: int) -> np.ndarray:
        """For each step and word, whether the walk goes on. Words outside the vocabulary share one row."""
        return self._rng(length, walk, 1).integers(0, 2, (self._steps(1 << length), len(self.vocabulary) + 1), np.int8)

    @staticmethod
    def _steps(least: int) -> int:
        return 2 * max(1, least // 2)

    def _grow(self, c: _Class, length: int, members: list[int]) -> None:
        """Adds a walk."""
        walk = len(c.keys)
        steps = self._steps(1 << length)
        drawn = self._rng(length, walk, 2)
        chosen = np.array([np.sort(drawn.choice(steps, min(SAMPLED_STEPS, steps), replace=False)) for _ in range(SAMPLES)])
        flat = np.concatenate([np.append(self.tokens[k], -1) for k in members])
        sizes = np.array([len(self.tokens[k]) for k in members])
        ends = np.cumsum(sizes + 1) - 1
        # From each word of an item at which a whole window still fits.
        offsets = np.concatenate([np.arange(s - c.window + 1) for s in sizes])
        of = np.repeat(np.arange(len(members)), sizes - c.window + 1)
        at = (ends - sizes)[of] + offsets
        walked = self._walked(flat, at, ends[of], self._bits(length, walk), chosen)
        keys, places = [], []
        place = np.column_stack([np.array(members)[of], offsets])
        for symbols in walked:
            good = np.all([s > 0 for s in symbols], axis=0)
            key = _key([s[good] for s in symbols])
            order = np.argsort(key, kind="stable")
            keys.append(key[order])
            places.append(place[good][order])
        c.steps.append(chosen)
        c.keys.append(keys)
        c.places.append(places)

    @staticmethod
    def _walked(flat: np.ndarray, at: np.ndarray, end: np.ndarray, bits: np.ndarray, chosen: np.ndarray) -> list[list[np.ndarray]]:
        """For each sample the words that the walks from ``at`` show at its steps."""
        wanted: dict[int, np.ndarray] = {}
        pos = at.copy()
        needed = set(chosen.ravel().tolist())
        for j in range(int(chosen.max()) + 1):
            symbol = flat[pos]
            if j in needed:
                wanted[j] = symbol
            pos = np.minimum(pos + bits[j][symbol], end)
        return [[wanted[j] for j in row] for row in chosen.tolist()]

    def _by_walk(self, c: _Class, length: int, walk: int, filters: list[np.ndarray], flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        windows = -(-sizes // c.window)
        of = np.repeat(np.arange(len(sizes)), windows)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
        at, end = starts[of] + nth * c.window, (starts + sizes)[of]
        found = []
        for s, symbols in enumerate(self._walked(flat, at, end, self._bits(length, walk), c.steps[walk])):
            good = np.flatnonzero(np.logical_and.reduce([x > 0 for x in symbols]))
            row, pick = _looked_up(_key([x[good] for x in symbols]), c.keys[walk][s], c.places[walk][s], filters[s])
            g = good[row]
            found.append(np.column_stack([of[g], pick[:, 0], at[g] - starts[of[g]] - pick[:, 1]]))
        return np.concatenate(found)

    @staticmethod
    def _by_pieces(c: _Class, filters: dict[int, np.ndarray], flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        of = np.repeat(np.arange(len(sizes)), sizes)
        at = np.arange(len(of)) + of
        found = [np.zeros((0, 3), np.int64)]
        for size, (table, places) in c.pieces.items():
            # A window past the end of a text meets its -1.
            good = at[at + size <= len(flat)]
            good = good[np.logical_and.reduce([flat[good + k] > 0 for k in range(size)])]
            row, pick = _looked_up(_key([flat[good + k] for k in range(size)]), table, places, filters[size])
            doc = np.searchsorted(starts, good[row], side="right") - 1
            found.append(np.column_stack([doc, pick[:, 0], good[row] - starts[doc] - pick[:, 1]]))
        return np.concatenate(found)

    def candidates(self, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Rows of (document, item, where the item would begin). Each document ends with -1 in ``flat``."""
        found = [np.zeros((0, 3), np.int64)]
        if self._filters is None:
            self._filters = [c.filters() if c.pieces is None else {n: _leading(k) for n, (k, _) in c.pieces.items()} for c in self.classes]
        for c, filters, (length, _) in zip(self.classes, self._filters, sorted(self.by_class.items()), strict=True):
            if c.pieces is not None:
                found.append(self._by_pieces(c, filters, flat, starts, sizes))
            for walk in range(len(c.keys)):
                found.append(self._by_walk(c, length, walk, filters[walk], flat, starts, sizes))
        return np.unique(np.concatenate(found), axis=0)

    def _trials(self, length: int, members: list[int], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Items of the class in random text after the most edits allowed, at different words: the items, and the texts as for
        :meth:`candidates`."""
        rng = self._rng(length, 3)
        texts, wanted = [], np.resize(rng.permutation(members), TRIALS)
        for k in wanted:
            t = self.tokens[k].tolist()
            for at in sorted(rng.choice(len(t), min(most_edits(len(t), self.edits), len(t)), replace=False).tolist(), reverse=True):
                what = rng.integers(3)
                if what == 0:
                    t[at] = 0
                elif what == 1:
                    t.insert(at, 0)
                elif len(t) > 1:
                    del t[at]
            texts.append(np.array([0] * int(rng.integers(max(40, 2 * window))) + t + [0] * 40 + [-1], np.int32))
        sizes = np.array([len(t) - 1 for t in texts])
        return wanted, np.concatenate(texts), np.cumsum(sizes + 1) - sizes - 1, sizes

    def _spans(self, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """Candidates as (document, item, first and last place where the item would begin); those of pieces are merged where they overlap."""
        exact = {k for c, (_, members) in zip(self.classes, sorted(self.by_class.items()), strict=True) if c.pieces is not None for k in members}
        held = None
        for d, k, at in self.candidates(flat, starts, sizes).tolist():
            if held and held[:2] == (d, k) and k in exact and at <= held[3] + len(self.tokens[k]):
                held = (d, k, held[2], at)
                continue
            if held:
                yield held
            held = (d, k, at, at)
        if held:
            yield held

    def hits(self, texts: list[list[int]]) -> list[tuple[int, int, int, int, int]]:
        """Verified ``(document, item, distance, start, end)``, the best passage of each pair."""
        sizes = np.array([len(t) for t in texts])
        flat = np.concatenate([np.array([*t, -1], np.int32) for t in texts])
        lists = [(t, set(t)) for t in map(np.ndarray.tolist, self.tokens)]
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        beyond: dict[tuple[int, int], int] = {}
        for d, k, first, last in self._spans(flat, np.cumsum(sizes + 1) - sizes - 1, sizes):
            item, own = lists[k]
            most = most_edits(len(item), self.edits)
            lo, hi = max(0, first - most), min(int(sizes[d]), last + len(item) + most)
            if beyond.get((d, k), -1) >= hi:
                continue
            beyond[d, k] = hi
            lo = max(0, lo - most)
            near = texts[d][lo:hi + most]
            # A passage so near has all but ``most`` of the item's words.
            if sum(map(own.__contains__, near)) >= len(item) - most and passage_distance(item, near)[0] <= most:
                distance, start, end = best_passage(item, near)
                new = (distance, lo + start, lo + end)
                best[d, k] = min(best.get((d, k), new), new)
        return [(d, k, *v) for (d, k), v in sorted(best.items())]


def _block_hits(docs: DataFrame, index: Index, item_kind: str, item_type: pa.DataType) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "text_key", "item_id", "distance", "start", "end", "n_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = index.vocabulary.get
        for b in batches:
            texts, rows, chars = [], [], 0
            for row in range(b.num_rows + 1):
                text = b.column(2)[row].as_py() if row < b.num_rows else None
                if text:
                    texts.append([get(w, 0) for w in words_of(text)])
                    rows.append(row)
                    chars += len(text)
                if texts and (chars >= _CHUNK_CHARS or row == b.num_rows):
                    found = index.hits(texts)
                    if found:
                        at = pa.array([rows[f[0]] for f in found])
                        yield pa.RecordBatch.from_arrays([
                            b.column(0).take(at), b.column(1).take(at), pa.array([index.ids[f[1]] for f in found], item_type),
                            *(pa.array([f[k] for f in found], pa.int64()) for k in (2, 3, 4)),
                            pa.array([len(index.words[f[1]]) for f in found], pa.int64())], names)
                    texts, rows, chars = [], [], 0

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, text_key long, item_id {item_kind}, distance long, start long, end long, n_words long")


def contaminations(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS, recall: float = RECALL) -> DataFrame:
    """One row per document and item in it: distance, and the first best passage as word positions."""
    from pyspark.sql.pandas.types import to_arrow_type

    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    chars = items.agg(F.coalesce(F.sum(F.length("text") + 20), F.lit(0))).first()[0]
    blocks = max(1, -(-chars // BLOCK_CHARS))
    field = items.schema["item_id"]
    out = None
    for k in range(blocks):
        block = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text").collect()
        index = Index([(r["item_id"], words_of(r["text"])) for r in block], edits, recall)
        found = _block_hits(docs, index, field.dataType.simpleString(), to_arrow_type(field.dataType))
        out = found if out is None else out.union(found)
    return out


def clean_documents(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS, recall: float = RECALL) -> DataFrame:
    """The rows of ``docs`` with no passage of ``benchmark``; columns unchanged."""
    bad = contaminations(docs, benchmark, edits, recall).select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct()
    keyed = docs.withColumn("__text_key", F.xxhash64("text"))
    return keyed.join(bad, keyed["doc_id"].eqNullSafe(bad["__id"]) & (keyed["__text_key"] == bad["__key"]), "left_anti").select(*docs.columns)
