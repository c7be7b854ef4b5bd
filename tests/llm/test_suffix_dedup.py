import hashlib
import random
from collections import Counter

import pytest

from shelftide.llm import queries, suffix_dedup

from . import cases


def brute(rows, length):
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[i:i + length] for _, b in texts for i in range(len(b) - length + 1))
    out = []
    for d, b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((d, len(b), sum(gone), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def made(seed):
    rng = random.Random(seed)
    parts = ["ab", "cde", "fgh", "xyz", "aa", " ", "\n", "é"]
    text = lambda n: "".join(rng.choice(parts) for _ in range(n))
    base = [text(120) for _ in range(6)]
    rows = [(i, text(rng.randint(0, 60)) + rng.choice(base)[rng.randint(0, 40):] + text(rng.randint(0, 90))) for i in range(60)]
    rows += [(100, "a" * 700), (101, "a" * 39), (102, "b" * 41 + "a" * 50), (105, base[0]), (105, base[0]), (106, "ab" * 300), (None, base[1] + "q"), (107, text(20) + "ab" * 60)]
    return rows


@pytest.mark.parametrize("hot", [suffix_dedup.HOT_GROUP, 3])
def test_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_GROUP", hot)
    rows = made(hot)
    got = suffix_dedup.remove_repeats(cases.docs(spark, [cases.row(*r) for r in rows]), 40).drop("kept").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 40)


def test_query_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, queries.op4_suffix_dedup(spark, sf_dir).collect()), key=str) == brute(rows, 400)


def test_edges(spark):
    rows = [(r[0], r[1]) for r in cases.ROWS]
    got = suffix_dedup.remove_repeats(cases.docs(spark)).drop("kept").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 400)
    assert suffix_dedup.remove_repeats(cases.empty(spark)).count() == 0
