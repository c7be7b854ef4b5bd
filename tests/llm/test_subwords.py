import zlib

import numpy as np
import pyarrow as pa
import pytest

from shelftide.llm import queries, subwords

from . import cases

LABELS = "doc_id long, quality int, toxic int, score string"


def plain(text):
    """Buckets of a text's tokens, token by token."""
    mask = 2**64 - 1
    step, mix = int(subwords._STEP), int(subwords._MIX)

    def mixed(x):
        x = ((x ^ (x >> 31)) * mix) & mask
        return x ^ (x >> 29)

    def bucket(x, kind):
        return mixed((x + kind * step) & mask) % subwords.BUCKETS

    raw = [32 if b == 32 or 9 <= b <= 13 else b for b in f" {text} ".encode()]
    out = []
    for n in subwords.GRAMS:
        for i in range(len(raw) - n + 1):
            part = raw[i:i + n]
            if 32 in part[1:-1] or part == [32, 32]:
                continue
            h = (part[0] + 1) * step & mask
            for b in part[1:]:
                h = (mixed(h) + (b + 1) * step) & mask
            out.append(bucket(h, n))
    hashes = []
    for word in bytes(raw).split(b" "):
        if word:
            hashes.append(mixed(sum((b + 1) * mixed((k + step) & mask) for k, b in enumerate(word)) & mask))
    return sorted(out + [bucket(h, 0) for h in hashes] + [bucket(a ^ b, 1) for a, b in zip(hashes, hashes[1:])])


def read(texts):
    found = [[] for _ in texts]
    for row, bucket in subwords.Reader(pa.array(texts, pa.string())):
        for r, b in zip(row.tolist(), bucket.tolist()):
            found[r].append(b)
    return [sorted(f) for f in found]


TEXTS = ["two words", None, "", "a", " \t\n", "Ünï ſ 😀  text\x0bmore", "the the the", "x" * 50, "end"]


def test_tokens_equal_the_plain_way():
    assert read(TEXTS) == [plain(t or "") for t in TEXTS]


@pytest.mark.parametrize("size", [64, 200])
def test_slices_lose_pairs_at_cuts_only(monkeypatch, size):
    monkeypatch.setattr(subwords, "SLICE", size)
    long = " ".join(f"word{k}" for k in range(200))
    texts = [*TEXTS, long, "after"]
    found = read(texts)
    assert found[:len(TEXTS)] == [plain(t or "") for t in TEXTS] and found[-1] == plain("after")
    whole = plain(long)
    lost = len(whole) - len(found[-2])
    assert 0 < lost < 2 * len(long) / size + 2
    kept = np.bincount(found[-2], minlength=subwords.BUCKETS)
    assert (kept <= np.bincount(whole, minlength=subwords.BUCKETS)).all()


def test_doubled_words_share_a_bucket():
    same = {b for a in ("foo", "barbar", "ü") for b in set(read([f"{a} {a}"])[0]) & set(read(["qq qq"])[0])}
    assert len(same) == 1


def test_held_out_labels(spark):
    """Documents and labels the fit has not seen."""
    sf_dir = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in queries.op12_quality_classifier(spark, sf_dir).collect()}
    assert len(got) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for k, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(k).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    labels = [r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if r["quality"] is not None and got[r["doc_id"]]["held_out"]]
    right = [got[r["doc_id"]]["predicted"] == r["quality"] for r in labels]
    assert len(right) > 50 and np.mean(right) > 0.95


def test_labels_of_held_out_rows_do_not_count(spark, tmp_path):
    docs = cases.docs(spark, [cases.row(k, f"{'good' if k % 2 else 'bad'} text {k}") for k in range(60)])
    for flip in (0, 1):
        rows = [(k, k % 2 ^ (flip if zlib.crc32(str(k).encode()) % 5 == 0 else 0), 0, "x") for k in range(60)]
        docs.write.mode("overwrite").parquet(f"{tmp_path}/{flip}/documents.parquet")
        spark.createDataFrame(rows, LABELS).write.parquet(f"{tmp_path}/{flip}/labels.parquet")
    first, second = (sorted(queries.op12_quality_classifier(spark, f"{tmp_path}/{flip}").collect()) for flip in (0, 1))
    assert first == second
    assert all(r["predicted"] == r["doc_id"] % 2 for r in first)


def test_edges(spark):
    labels = spark.createDataFrame([(1, 1, 0, "x"), (2, 0, None, "x"), (3, None, 0, "x"), (None, 1, 0, "x"), (99, 0, 0, "x"), (1, 1, 0, "x")], LABELS)
    docs = cases.docs(spark)
    got = subwords.classify(docs, labels).collect()
    assert len(got) == len(cases.ROWS) and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (1, 2)}) == 1
    empty = {r["score"] for r in got if r["doc_id"] in (3, 4, 7)}
    assert len(empty) == 1
    none = subwords.classify(docs, labels.filter("false")).collect()
    assert {r["score"] for r in none} == {0.5}
    good = subwords.classify(docs, labels.filter("quality = 1")).collect()
    assert all(r["score"] > 0.99 for r in good)
    assert subwords.classify(cases.empty(spark), labels).count() == 0
