"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints: a bit is the majority of that bit over the XXH64 of all word shingles, repeats included.

Two fingerprints with at most ``distance`` differing bits must, for parts of the bits with thresholds ``t_i`` that sum to
``distance - parts + 1``, differ in at most ``t_i`` bits of some part. Bits whose values go together share a part, so that
parts differ in how well they select; a dynamic programme gives each part its threshold, by the candidates and probes
expected from the bit statistics of all fingerprints. A part with threshold -1 is not probed at all.

Every distinct fingerprint is placed under its own value of a part and probes the values within the threshold. A bucket
with more than ``HOT_BUCKET`` rows is dealt out again by equal values of further groups of bits: rows within the distance
must agree in one of ``distance + 1`` groups of the bits not used so far. Buckets emit only the pairs that span their
groups of near fingerprints, never all pairs. Links are joined by :func:`.components.components`.

Null and empty texts have no shingle and fingerprint zero, linked like any other. Repeated rows share a fingerprint. A null
id never becomes a component's id, unless no other id is in it. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import stored

BITS = 64
SHINGLE = 4
DISTANCE = 4
HOT_BUCKET = 20_000
#: Buckets up to this size are compared pair by pair, larger ones by growing groups.
SMALL_BUCKET = 32
#: Cost of one probe row against one compared pair: a row is shuffled and sorted, a pair is one vector operation.
PROBE_COST = 100.0
_BLOCK = 1 << 15


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    words = (text or b"").lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    m = max(1, n - size + 1)
    first, last = starts[:m].tolist(), ends[min(size, n) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for k in range(0, m, _BLOCK):
        h = np.array([digest(joined[a:b], 42) for a, b in zip(first[k:k + _BLOCK], last[k:k + _BLOCK], strict=True)], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > m, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``(doc_id, text_key, fp)`` per row; ``fp`` holds the 64 bits as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2).cast(pa.large_binary()) if b.num_rows else ()
            fp = np.fromiter((fingerprint(x.as_py(), size) for x in texts), "<u8", b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view("<i8"))], ["doc_id", "text_key", "fp"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_key long, fp long")


def _bits(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(fp).view("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_statistics(points: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how often each pair of bits is set together, over all of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS)), 0
        for b in batches:
            x = _bits(b.column(0).to_numpy(zero_copy_only=False)).astype(np.float32)
            total += x.T @ x
            n += len(x)
        if n:
            at = np.append(np.arange(BITS * BITS), -1)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.append(total.ravel(), n).astype(np.int64))], ["at", "n"])

    counts = dict(points.select("fp").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n")).toLocalIterator())
    both = np.array([counts.get(k, 0) for k in range(BITS * BITS)], float).reshape(BITS, BITS)
    return counts.get(-1, 0), both


def correlated_parts(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of about equal size; each grows by the bit that goes best with those it has."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    near = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    left, out = list(range(BITS)), []
    for k in range(parts):
        size = -(-len(left) // (parts - k))
        seed = max(left, key=lambda b: (near[b, left].sum(), -b))
        group = [seed]
        left.remove(seed)
        while len(group) < size:
            best = max(left, key=lambda b: (near[b, group].sum(), -b))
            group.append(best)
            left.remove(best)
        out.append(sorted(group))
    return out


def allocate(n: int, both: np.ndarray, groups: list[list[int]], distance: int) -> tuple[float, list[int]]:
    """Least expected cost, and the threshold of each part, by dynamic programming over what is left to give out."""
    p = np.diag(both) / max(n, 1)
    differ = 2 * p * (1 - p)
    costs = []
    for bits in groups:
        chance = np.zeros(distance + 1)
        chance[0] = 1
        for b in bits:
            chance[1:] = chance[1:] * (1 - differ[b]) + chance[:-1] * differ[b]
            chance[0] *= 1 - differ[b]
        ways, row = 1.0, [0.0]
        probes = 0.0
        for t in range(distance + 1):
            probes += ways
            ways = ways * (len(bits) - t) / (t + 1)
            row.append(PROBE_COST * n * probes + n * n / 2 * chance[: t + 1].sum())
        costs.append(row)
    # A part with threshold t takes t + 1 of the distance + 1 that have to be given out in all.
    best = {0: (0.0, [])}
    for row in costs:
        grown: dict[int, tuple[float, list[int]]] = {}
        for (given, (cost, chosen)), (t, c) in itertools.product(best.items(), enumerate(row, -1)):
            if given + t + 1 <= distance + 1 and (given + t + 1 not in grown or cost + c < grown[given + t + 1][0]):
                grown[given + t + 1] = (cost + c, [*chosen, t])
        best = grown
    return best[distance + 1]


def plan(n: int, both: np.ndarray, distance: int) -> list[tuple[list[int], int]]:
    """The parts to probe and their thresholds."""
    tried = []
    for m in range(1, distance + 2):
        groups = correlated_parts(n, both, m)
        tried.append((*allocate(n, both, groups, distance), groups))
    _, thresholds, groups = min(tried, key=lambda x: x[0])
    return [(g, t) for g, t in zip(groups, thresholds, strict=True) if t >= 0]


def _mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def _placed(points: DataFrame, parts: list[tuple[list[int], int]]) -> DataFrame:
    """``(bucket, own, used, fp)``: every fingerprint under its own values and under those it probes."""
    flips = []
    for k, (bits, most) in enumerate(parts):
        for t in range(most + 1):
            flips += [(k, _mask(bits), _mask(list(c)), t == 0) for c in itertools.combinations(bits, t)]
    part = np.array([f[0] for f in flips], np.int64)
    mask = np.array([f[1] for f in flips], np.uint64)
    flip = np.array([f[2] for f in flips], np.uint64)
    own = np.array([f[3] for f in flips])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, 1_000_000 // len(part))
        for b in batches:
            whole = b.column(0).to_numpy(zero_copy_only=False).view("<u8")
            for k in range(0, len(whole), step):
                fp = whole[k:k + step]
                value = (fp[:, None] & mask) ^ flip
                bucket = _mixed(value.ravel(), np.tile(part, len(fp)))
                yield pa.RecordBatch.from_arrays([
                    pa.array(bucket.view("<i8")), pa.array(np.tile(own, len(fp))), pa.array(np.tile(mask, len(fp)).view("<i8")),
                    pa.array(np.repeat(fp, len(part)).view("<i8"))], ["bucket", "own", "used", "fp"])

    return points.select("fp").mapInArrow(run, "bucket long, own boolean, used long, fp long")


def _mixed(value: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """A bucket's key. Two buckets that share a key only compare more pairs."""
    with np.errstate(over="ignore"):
        x = value ^ (salt.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _refined(rows: DataFrame, distance: int) -> DataFrame:
    """Rows of hot buckets under further keys, one for each of ``distance + 1`` groups of the bits not used so far."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bucket, used, fp = (b.column(k).to_numpy(zero_copy_only=False).view("<u8") for k in (0, 2, 3))
            for g in range(distance + 1):
                mask = np.zeros(len(fp), np.uint64)
                for u in np.unique(used):
                    free = [k for k in range(BITS) if not int(u) >> k & 1]
                    mask[used == u] = _mask(free[g::distance + 1])
                key = _mixed(_mixed(fp & mask, np.full(len(fp), g)) ^ bucket, np.full(len(fp), BITS))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view("<i8")), b.column(1), pa.array((used | mask).view("<i8")), b.column(3)], ["bucket", "own", "used", "fp"])

    return rows.mapInArrow(run, "bucket long, own boolean, used long, fp long")


def _near(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= distance


def _spanning(fp: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that join every group of near fingerprints in one bucket."""
    out, left = [], fp
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            x = front.pop()
            hit = _near(left, x, distance)
            if hit.any():
                found = left[hit]
                out.append((np.full(len(found), x), found))
                front.extend(found)
                left = left[~hit]
    return out


def _links(rows: DataFrame, distance: int) -> DataFrame:
    """Verified links from rows dealt out and sorted by bucket."""
    def matched(bucket: np.ndarray, own: np.ndarray, fp: np.ndarray) -> pa.RecordBatch | None:
        starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        sizes = np.diff(np.append(starts, len(bucket)))
        found = []
        size_of = np.repeat(sizes, sizes)
        at = np.flatnonzero((size_of > 1) & (size_of <= SMALL_BUCKET))
        end_of = np.repeat(starts + sizes, sizes)
        lag = 1
        while len(at := at[at + lag < end_of[at]]):
            hit = at[_near(fp[at], fp[at + lag], distance) & (own[at] | own[at + lag])]
            found.append((fp[hit], fp[hit + lag]))
            lag += 1
        for s, n in zip(starts[sizes > SMALL_BUCKET], sizes[sizes > SMALL_BUCKET], strict=True):
            found += _spanning(np.unique(fp[s:s + n]), distance)
        u, v = (np.concatenate([x[k] for x in found] or [np.zeros(0, np.uint64)]) for k in (0, 1))
        keep = u != v
        return pa.RecordBatch.from_arrays([pa.array(u[keep].view("<i8")), pa.array(v[keep].view("<i8"))], ["u", "v"]) if keep.any() else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in itertools.chain(batches, (None,)):
            if b is not None:
                new = [b.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 3)]
                new[2] = new[2].view("<u8")
                held = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
                if not len(held[0]):
                    continue
                whole = int(np.searchsorted(held[0], held[0][-1])) if held[0][0] != held[0][-1] else 0
            else:
                whole = len(held[0]) if held is not None else 0
            if whole:
                out = matched(*[x[:whole] for x in held])
                held = [x[whole:] for x in held]
                if out is not None:
                    yield out

    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "u long, v long")


def near_links(points: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs ``(u, v)`` of distinct fingerprints that join all within ``distance``; ``points`` holds each ``fp`` once."""
    n, both = bit_statistics(points)
    rows = _placed(points, plan(n, both, distance))
    out = None
    while True:
        rows = stored(rows)
        hot = stored(rows.groupBy("bucket").count().filter(F.col("count") > HOT_BUCKET).select("bucket"))
        more = not hot.isEmpty()
        cool = rows.join(hot, "bucket", "left_anti") if more else rows
        found = _links(cool, distance)
        out = found if out is None else out.union(found)
        if not more:
            return out.distinct()
        rows = _refined(rows.join(hot, "bucket").select("bucket", "own", "used", "fp"), distance)


def near_components(docs: DataFrame, size: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``(doc_id, text_key, fp, root, component_id)`` per row: a fingerprint and the least id that links reach."""
    prints = stored(fingerprints(docs, size))
    points = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(near_links(points, distance))
    rooted = points.join(roots, points["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(rooted.join(ids, "root").select("fp", "root", "component_id"), "fp").select("doc_id", "text_key", "fp", "root", "component_id")


def keep_one(docs: DataFrame, size: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one row of each component: the least id, then the least text key; columns unchanged."""
    stay = (
        near_components(docs, size, distance).groupBy("root").agg(F.min(F.struct("doc_id", "text_key")).alias("s"))
        .select(F.col("s.doc_id").alias("__id"), F.col("s.text_key").alias("__key"))
    )
    keyed = docs.withColumn("__text_key", F.xxhash64("text"))
    return (
        keyed.join(stay, keyed["doc_id"].eqNullSafe(stay["__id"]) & (keyed["__text_key"] == stay["__key"]), "left_semi")
        .dropDuplicates(["doc_id", "__text_key"]).select(*docs.columns)
    )
