import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from shelftide.llm import ctw, queries

from . import cases


def kt_log(bits):
    n, total = [0, 0], 0.0
    for b in bits:
        total += math.log((n[b] + 0.5) / (sum(n) + 1))
        n[b] += 1
    return total


def test_block_probability_equals_step_by_step():
    rng = random.Random(16)
    for _ in range(50):
        bits = [rng.randint(0, 1) for _ in range(rng.randint(0, 60))]
        got = ctw.block_log(np.array([float(bits.count(0))]), np.array([float(bits.count(1))]))[0]
        assert got == pytest.approx(kt_log(bits), abs=1e-9)


def brute(texts, depth):
    """The weighted tree by its recursion, over dictionaries."""
    seen: dict = {}
    for t in texts:
        padded = b"\n" * depth + t
        for k in range(depth, len(padded)):
            for j in range(8):
                for d in range(depth + 1):
                    counts = seen.setdefault((padded[k - d:k], (1 << j) | padded[k] >> (8 - j)), [0, 0])
                    counts[padded[k] >> (7 - j) & 1] += 1
    longer: dict = {}
    for context, bits in seen:
        if context:
            longer.setdefault((context[1:], bits), []).append((context, bits))

    memo: dict = {}

    def log_weighted(node):
        if node not in memo:
            n0, n1 = seen[node]
            own = kt_log([0] * n0 + [1] * n1)
            if len(node[0]) == depth:
                memo[node] = (own, 1.0)
            else:
                below = sum(log_weighted(x)[0] for x in longer[node])
                both = math.log(math.exp(own - max(own, below)) + math.exp(below - max(own, below))) + max(own, below)
                memo[node] = (both - math.log(2), math.exp(own - both))
        return memo[node]

    def probability_of_one(history, bits):
        total, rest, last = 0.0, 1.0, 0.5
        for d in range(depth + 1):
            node = (history[len(history) - d:], bits)
            if node not in seen:
                break
            n0, n1 = seen[node]
            last = (n1 + 0.5) / (n0 + n1 + 1)
            weight = log_weighted(node)[1]
            total += rest * weight * last
            rest *= 1 - weight
        return total + rest * last

    return lambda history, byte: sum(
        math.log(p if byte >> (7 - j) & 1 else 1 - p) for j in range(8) for p in [probability_of_one(history, (1 << j) | byte >> (8 - j))])


def model_of(spark, texts, depth):
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    return ctw.build_model(ctw.stored(ctw.corpus_counts(frame, depth)), depth)


@pytest.mark.parametrize("depth", [2, 4])
def test_model_equals_the_recursion(spark, depth):
    texts = ["abracadabra abra", "a cab a bar", "", "bar abra éa", "abracadabra abra"]
    model, log = model_of(spark, texts, depth), brute([ctw.coded(t.encode())[1] for t in texts], depth)
    for t in ["abra cab", "zzz é", "bar", ""]:
        data = ctw.coded(t.encode())[1]
        padded = b"\n" * depth + data
        want = [log(padded[k - depth:k], padded[k]) for k in range(depth, len(padded))]
        assert model.log_probability(ctw.grams([data], depth)[0]) == pytest.approx(want, abs=1e-4)


def test_probabilities_sum_to_one(spark):
    model = model_of(spark, ["some words and some other words"] * 3, 3)
    for context in (b"wor", b"\n\n\n", b"xyz", b"so\xc3"):
        head = np.uint64(int.from_bytes(context, "big") << 8)
        assert np.exp(model.log_probability(head + np.arange(256, dtype=np.uint64))).sum() == pytest.approx(1)


def test_query_base_score_and_held_out_gain(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    train = Counter()
    out = lambda d: zlib.crc32(str(d).encode()) % 5 == 1
    tokens = lambda t: [*(t or "").encode().lower().split(), b"\n"]
    for d, t in rows:
        if not out(d):
            train.update(tokens(t))
    n, v = sum(train.values()), len(train)
    got = {r["doc_id"]: r for r in queries.op7_lm_scoring(spark, sf_dir).collect()}
    assert len(got) == len(rows)
    for d, t in rows:
        r = got[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (out(d), len(tokens(t)), sum(w in train for w in tokens(t)), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((train[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t)))
    bits = [r["bits_per_byte"] for r in got.values() if r["held_out"]]
    assert 0 < np.mean(bits) < 3.5


def test_rare_words_are_joined(spark, monkeypatch, sf_dir):
    want = {r[0]: r["base_score"] for r in queries.op7_lm_scoring(spark, sf_dir).collect()}
    monkeypatch.setattr(ctw, "FREQUENT", 50)
    got = {r[0]: r["base_score"] for r in queries.op7_lm_scoring(spark, sf_dir).collect()}
    assert got == pytest.approx(want)


@pytest.mark.parametrize("frequent", [1, 1 << 22])
def test_scores_use_all_nodes(spark, monkeypatch, frequent):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abc ") for _ in range(rng.randint(0, 40))) for _ in range(60)]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    monkeypatch.setattr(ctw, "FREQUENT_STRINGS", frequent)
    monkeypatch.setattr(ctw, "SLOT_BITS", 4, raising=False)
    log = brute([ctw.coded(t.encode())[1] for k, t in enumerate(texts) if not ctw.held_out(k)], 4)
    for r in ctw.score_documents(frame, 4).collect():
        padded = b"\n" * 4 + ctw.coded(texts[r["doc_id"]].encode())[1]
        assert r["score"] == pytest.approx(sum(log(padded[k - 4:k], padded[k]) for k in range(4, len(padded))) / math.log(10), abs=1e-6)


def test_edges(spark):
    rows = ctw.score_documents(cases.docs(spark), 3).collect()
    assert len(rows) == len(cases.ROWS) and all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert {(r["n_tokens"], r["n_bytes"]) for r in rows if r["doc_id"] in (3, 4, 7)} == {(1, 1)}
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2)}) == 1
    assert ctw.score_documents(cases.empty(spark)).count() == 0
