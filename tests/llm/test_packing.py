import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shelftide.llm import packing, queries

from . import cases

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_encoder_equals_the_tokenizer(tokenizer):
    rng = random.Random(4)
    parts = ["it's", " don't", "'ll", " ", "  ", "\n", "\t", "abc", "Été", "ß", "12", "_", "__x", "!?", " $", "'s", "’", "½", "😀", "<|endoftext|>", "\r\n", "\x0b"]
    texts = ["", " ", *("".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(1500))]
    for text, raw in zip(texts, packing.Encoder(PATH)(texts), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("n", [1, 2, 9, 10, 11, 20, 21, 105])
def test_cut_points(n):
    cut = packing.cut_points(n, 10)
    assert [s for s, _ in cut] == list(itertools.accumulate([0, *(k for _, k in cut)]))[:-1] and sum(k for _, k in cut) == n
    assert all(k == 10 for _, k in cut[1:]) and 1 <= cut[0][1] <= 10


def fewest(items, capacity):
    best = len(items)

    def go(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(items):
            best = len(bins)
            return
        for j in range(len(bins)):
            if bins[j] + items[k] <= capacity and bins[j] not in bins[:j]:
                go(k + 1, [*bins[:j], bins[j] + items[k], *bins[j + 1:]])
        go(k + 1, [*bins, items[k]])

    go(0, [])
    return best


def test_reduction_keeps_a_best_packing():
    rng = random.Random(5)
    for _ in range(300):
        capacity = rng.choice([10, 17, 30])
        items = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 9))), reverse=True)
        counts = [items.count(k) for k in range(capacity + 1)]
        fixed = packing.reduce_instance(counts, capacity)
        rest = [k for k in range(capacity, 0, -1) for _ in range(counts[k])]
        assert all(sum(a * b for a, b in p) <= capacity for p, _ in fixed)
        assert sum(n for _, n in fixed) + (fewest(rest, capacity) if rest else 0) == fewest(items, capacity), items


def test_patterns_hold_every_piece():
    rng = random.Random(6)
    histogram = defaultdict(int)
    for _ in range(5000):
        histogram[min(2048, int(rng.lognormvariate(6, 1.2)) + 1)] += 1
    found = packing.patterns(dict(histogram))
    held = defaultdict(int)
    for pattern, bins in found:
        assert sum(a * b for a, b in pattern) <= 2048
        for a, b in pattern:
            held[a] += b * bins
    assert held == histogram
    assert sum(n for _, n in found) <= 1.02 * sum(a * b for a, b in histogram.items()) / 2048 + 1


def check_placed(rows):
    ends = defaultdict(list)
    for r in rows:
        ends[r["sequence_id"]].append((r["offset"], r["length"]))
    for placed in ends.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 2048


def test_query_round_trip(spark, sf_dir, tokenizer):
    rows = queries.op2_best_fit_packing(spark, sf_dir).collect()
    check_placed(rows)
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(by_doc) == len(docs)
    for doc_id, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        own = sorted(by_doc[doc_id], key=lambda r: r["piece"])
        assert [(r["start"], r["length"]) for r in own] == packing.cut_points(len(ids))
        assert all(zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"] for r in own)


def test_edges(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ROWS", 2)
    rows = packing.pack_documents(cases.docs(spark), PATH, with_ids=True).collect()
    check_placed(rows)
    assert sum(r["piece"] == 0 for r in rows) == len(cases.ROWS)
    assert [r["ids"] for r in rows if r["doc_id"] in (3, 4)] == [[0], [0]]
    assert packing.pack_documents(cases.empty(spark), PATH).count() == 0
