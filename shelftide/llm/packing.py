"""Best-fit packing of tokenised documents after Martello-Toth dominance reduction.

Documents become pieces of at most ``capacity`` tokens. Pieces of one length are alike to the packer, so the instance is a
histogram of at most ``capacity`` lengths, however many pieces there are. The reduction fixes bins that provably belong to
some best packing; best-fit in falling order packs the rest. Both work on whole groups of equal bins, so the result is
a short list of patterns with a number of bins each. Pieces get a rank within their length from counts per (length, salt)
and take the slot of that rank; no group of rows is larger than ``GROUP_ROWS`` on average.

Null text is empty: one piece that holds only the closing id. Repeated rows are packed as often as they occur. An empty
table gives an empty result. Long texts give many pieces, of which only the first may be shorter than ``capacity``.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

CAPACITY = 2048
CLOSING_ID = 0
GROUP_ROWS = 100_000
#: Word pieces that a worker remembers; it starts anew when full.
REMEMBERED = 400_000

# Texts of these characters only are cut by the plain pattern below, which then does what the tokenizer's own does.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ſ"
_PLAIN = re.compile(f"[\\x20-\\x7e\\t\\n\\r\\x0b\\x0c{_LETTERS}]*")
_CUT = re.compile(r" ?[A-Za-zÀ-ſ]+|'(?:[stmd]|re|ve|ll)| ?[0-9]+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Encoder:
    """Token ids of whole texts as little-endian bytes. Equal word pieces are encoded once.

    Word pieces go through the ranks of the same vocabulary file, whose ids are its merge ranks; a text with characters
    beyond the plain ones goes through the tokenizer as it is.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        special = self.tokenizer.get_added_tokens_decoder()
        byte_of = _byte_of()
        ranks = {bytes(map(byte_of.__getitem__, t)): k for t, k in self.tokenizer.get_vocab(False).items() if k not in special}
        self.words = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes] = {}

    def _encoded(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        for k in range(0, len(texts), 256):
            some = texts[k:k + 256]
            cut = [_CUT.findall(t) if _PLAIN.fullmatch(t) else None for t in some]
            if len(self.known) > REMEMBERED:
                self.known = {}
            for word in set().union(*(c for c in cut if c)) - self.known.keys():
                self.known[word] = np.array(self.words.encode_ordinary(word), "<u4").tobytes()
            for t, c in zip(some, cut, strict=True):
                yield self._encoded(t) if c is None else b"".join(map(self.known.__getitem__, c))


def cut_points(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of a document of ``n`` tokens."""
    first = (n - 1) % capacity + 1
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(tokenizer)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            at, out, ids = [], [], []
            for row, raw in enumerate(encode(texts)):
                raw += CLOSING_ID.to_bytes(4, "little")
                for piece, (start, length) in enumerate(cut_points(len(raw) // 4, capacity)):
                    part = raw[4 * start:4 * (start + length)]
                    at.append(row)
                    out.append((piece, start, length, zlib.crc32(part)))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
            columns = np.array(out, np.int64).reshape(-1, 4)
            arrays = [b.column(0).take(pa.array(at, pa.int64())), pa.array(columns[:, 0].astype(np.int32)), *(pa.array(columns[:, k]) for k in (1, 2, 3))]
            if with_ids:
                arrays.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(arrays)])

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(run, schema)


Pattern = tuple[tuple[int, int], ...]


def _largest(counts: list[int], most: int) -> int:
    """The largest length up to ``most`` that is left, or 0."""
    while most > 0 and not counts[most]:
        most -= 1
    return max(most, 0)


def _smallest_two(counts: list[int]) -> tuple[int, int]:
    found = []
    for length, n in enumerate(counts):
        found += [length] * min(n, 2)
        if len(found) >= 2:
            return found[0], found[1]
    return (found[0], 0) if found else (0, 0)


def reduce_instance(counts: list[int], capacity: int) -> list[tuple[Pattern, int]]:
    """Takes from ``counts`` the bins that dominate every other bin with their largest item; returns them.

    For an item j and what else can stand beside it: nothing fits, so {j}; only one more fits, or one fills the bin, so {j, i}
    with the largest i that fits; two more at most, so {j, i} if i is as large as the best pair together, or {j, i, k} if i
    is the largest that fits alone, k fits beside both, and no smaller partner of a pair can be larger than k.
    """
    fixed: list[tuple[Pattern, int]] = []

    def fix(*items: int) -> None:
        need = Counter(items)
        times = min(counts[x] // n for x, n in need.items())
        for x, n in need.items():
            counts[x] -= times * n
        fixed.append((tuple(sorted(need.items(), reverse=True)), times))

    changed = True
    while changed:
        changed = False
        for j in range(capacity, 0, -1):
            while counts[j]:
                counts[j] -= 1
                room = capacity - j
                a, b = _smallest_two(counts)
                i = _largest(counts, room)
                chosen: tuple[int, ...] | None = None
                if not a or a > room:
                    chosen = (j,)
                elif i == room or not b or a + b > room:
                    chosen = (j, i)
                elif 3 * a > room:
                    counts[i] -= 1
                    k = _largest(counts, room - i)
                    half = _largest(counts, room // 2)
                    counts[i] += 1
                    best = 0
                    for x in range(i, 0, -1):
                        if counts[x]:
                            counts[x] -= 1
                            y = _largest(counts, min(room - x, x))
                            counts[x] += 1
                            best = max(best, x + y if y else 0)
                    if i >= best:
                        chosen = (j, i)
                    elif k and k >= half:
                        chosen = (j, i, k)
                counts[j] += 1
                if chosen is None or any(counts[x] < n for x, n in Counter(chosen).items()):
                    break
                fix(*chosen)
                changed = True
    return fixed


def best_fit(counts: list[int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit in falling order. Bins with equal contents are one entry, so the work depends on the lengths only."""
    open_bins: list[dict[Pattern, int]] = [{} for _ in range(capacity + 1)]

    def put(pattern: Pattern, room: int, bins: int) -> None:
        if bins:
            open_bins[room][pattern] = open_bins[room].get(pattern, 0) + bins

    for length in range(capacity, 0, -1):
        left = counts[length]
        while left:
            room = next((r for r in range(length, capacity) if open_bins[r]), capacity)
            pattern, bins = open_bins[room].popitem() if room < capacity else ((), left)
            each = room // length
            full = min(bins, left // each)
            put((*pattern, (length, each)), room - each * length, full)
            left -= full * each
            if full < bins:
                if left < each and left:
                    put((*pattern, (length, left)), room - left * length, 1)
                    full, left = full + 1, 0
                if pattern:
                    put(pattern, room, bins - full)
    return [(p, n) for at in open_bins for p, n in at.items()]


def patterns(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """``(((length, how many), ...), bins)`` for all pieces of a histogram of lengths."""
    counts = [0] * (capacity + 1)
    for length, n in histogram.items():
        counts[length] = n
    fixed = reduce_instance(counts, capacity)
    return [*fixed, *best_fit(counts, capacity)]


def _slots(found: list[tuple[Pattern, int]], capacity: int) -> dict[int, np.ndarray]:
    """Per length: rows of first rank, first sequence, bins, offset. A run of ranks goes bin by bin, then one place on."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    given = [0] * (capacity + 1)
    sequence = 0
    for pattern, bins in found:
        offset = 0
        for length, each in pattern:
            runs.setdefault(length, []).append((given[length], sequence, bins, offset))
            given[length] += each * bins
            offset += each * length
        sequence += bins
    return {k: np.array(v, np.int64) for k, v in runs.items()}


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``rows`` of :func:`pieces` with ``sequence_id`` and ``offset``. ``rows`` is read three times: pass a stored table."""
    histogram = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = _slots(patterns(histogram, capacity), capacity)
    salts = max(1, -(-max(histogram.values(), default=0) // GROUP_ROWS))
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    group = ["length", "__salt"]
    before = Window.partitionBy("length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    base = salted.groupBy(*group).agg(F.count(F.lit(1)).alias("__n")).withColumn("__base", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    rank = F.row_number().over(Window.partitionBy(*group).orderBy("doc_id", "piece", "ids_crc32"))
    ranked = salted.withColumn("__rank", rank).join(base.drop("__n"), group).withColumn("__rank", F.col("__rank") + F.col("__base") - 1)
    ranked = ranked.select(*rows.columns, "__rank")
    at_length, at_rank = ranked.columns.index("length"), ranked.columns.index("__rank")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, r = b.column(at_length).to_numpy(), b.column(at_rank).to_numpy()
            sequence, offset = np.zeros(len(r), np.int64), np.zeros(len(r), np.int64)
            for one in np.unique(length):
                own = length == one
                run_of = slots[int(one)][np.searchsorted(slots[int(one)][:, 0], r[own], side="right") - 1]
                nth = r[own] - run_of[:, 0]
                sequence[own] = run_of[:, 1] + nth % run_of[:, 2]
                offset[own] = run_of[:, 3] + nth // run_of[:, 2] * one
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(sequence), pa.array(offset)], [*b.schema.names[:-1], "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return ranked.mapInArrow(run, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    return pack(stored(pieces(docs, tokenizer, capacity, with_ids)), capacity)
