import random

import numpy as np
import pytest
import xxhash

from shelftide.llm import components, queries, simhash

from . import cases


def brute_fingerprint(text, size=4):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(pairs, distance):
    """Least id over links, for (id, fingerprint)."""
    prints = sorted({f for _, f in pairs})
    root = {f: f for f in prints}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(prints):
        for b in prints[i + 1:]:
            if (a ^ b).bit_count() <= distance:
                root[find(a)] = find(b)
    least = {}
    for d, f in pairs:
        least[find(f)] = min(least.get(find(f), d), d)
    return {(d, f): least[find(f)] for d, f in pairs}


def test_fingerprint_equals_brute_force():
    rng = random.Random(11)
    for _ in range(200):
        text = "".join(rng.choice(["Ab", "c", " ", "\n", "  ", "É", "x\x0by", " "]) for _ in range(rng.randint(0, 60)))
        assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)
    assert simhash.fingerprint(None) == simhash.fingerprint(b" \n") == 0


def test_query_equals_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    prints = [(d, brute_fingerprint(t)) for d, t in rows]
    want = brute_components(prints, 4)
    got = queries.op9_simhash_near_dedup(spark, sf_dir).collect()
    assert sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == sorted((d, f"{f:016x}", want[d, f]) for d, f in prints)


@pytest.mark.parametrize("hot,small", [(simhash.HOT_BUCKET, simhash.SMALL_BUCKET), (6, 2)])
def test_links_join_all_within_the_distance(spark, monkeypatch, hot, small):
    monkeypatch.setattr(simhash, "HOT_BUCKET", hot)
    monkeypatch.setattr(simhash, "SMALL_BUCKET", small)
    rng = random.Random(12)
    prints = {0, 1, (1 << 64) - 1}
    for _ in range(40):
        f = rng.getrandbits(64)
        for _ in range(rng.randint(1, 25)):
            prints.add(f)
            for b in rng.sample(range(64), rng.randint(0, 5)):
                f ^= 1 << b
    pairs = [(k, f) for k, f in enumerate(sorted(prints))]
    points = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for _, f in pairs], "fp long")
    links = [(r["u"] % 2**64, r["v"] % 2**64) for r in simhash.near_links(points).collect()]
    assert all((u ^ v).bit_count() <= 4 for u, v in links)
    found = {f: f for _, f in pairs}

    def find(f):
        while found[f] != f:
            f = found[f]
        return f

    for u, v in links:
        found[find(u)] = find(v)
    want = brute_components(pairs, 4)
    assert len({find(f) for _, f in pairs}) == len(set(want.values()))


def test_thresholds_meet_the_pigeonhole():
    rng = np.random.default_rng(1)
    x = rng.random((64, 64))
    for n in (10, 10_000, 10_000_000, 10**10):
        both = n * (x @ x.T) / 64
        parts = simhash.plan(n, both, 4)
        bits = sorted(b for g, _ in parts for b in g)
        assert len(set(bits)) == len(bits) and sum(t + 1 for _, t in parts) == 5


def test_components(spark):
    rng = random.Random(13)
    pairs = [(k, k + 1) for k in range(50)] + [(100, k) for k in range(101, 140)] + [(rng.randint(200, 300), rng.randint(200, 300)) for _ in range(60)] + [(5, 5)]
    root = {x: x for p in pairs for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in pairs:
        a, b = sorted((find(u), find(v)))
        root[b] = a
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}


def test_edges(spark):
    rows = simhash.near_components(cases.docs(spark)).collect()
    assert len(rows) == len(cases.ROWS)
    assert {r["component_id"] for r in rows if r["doc_id"] in (1, 2)} == {1}
    assert {r["component_id"] for r in rows if r["fp"] == 0} == {3}  # null, empty and blank texts, a null id among them
    kept = simhash.keep_one(cases.docs(spark))
    assert kept.columns == cases.DOCS.names
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["1", "None", "None", "5", "6", "8", "9", "10"])
    assert simhash.near_components(cases.empty(spark)).count() == simhash.keep_one(cases.empty(spark)).count() == 0
