import random
from pathlib import Path

import numpy as np
from pyspark.sql import types as T

from shelftide.llm import queries, toxicity

from . import cases

LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType()), T.StructField("text", T.StringType())])


def made(seed, n=600):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghijk", k=5)) for _ in range(300)]
    rows, labels = [], []
    for k in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(20, 200))]
        junk, toxic = rng.random() < 0.2, rng.random() < 0.2
        if junk:
            text = [w.upper() for w in text]
        if toxic:
            text[rng.randrange(len(text))] = rng.choice(["vile", "vilest", "rotten", "rottenly"])
        rows.append(cases.row(k, " ".join(text)))
        labels.append((k, int(not junk), int(toxic), "x"))
    return rows, labels


def test_chain_on_held_out_documents(spark):
    rows, labels = made(14)
    got = {r["doc_id"]: r for r in toxicity.toxicity(cases.docs(spark, rows), spark.createDataFrame(labels[:400], LABELS)).collect()}
    right = lambda name, test: np.mean([(got[d][name] >= 0.5) == test(q, t) for d, q, t, _ in labels[400:]])
    assert right("junk", lambda q, t: q == 0) > 0.95 and right("toxic", lambda q, t: t == 1) > 0.95


def test_later_models_use_earlier_probabilities():
    rng = np.random.default_rng(2)
    first = rng.integers(0, 2, 400).astype(float)
    texts = [("alpha " if f else "beta ") + " ".join(f"w{rng.integers(50)}" for _ in range(10)) for f in first]
    models = toxicity.fit_chain(texts, np.column_stack([first, first]), np.ones(400))
    assert len(models[0].earlier) == 0 and models[1].earlier[0] > 0


def test_sample_takes_all_labelled_rows_within_the_bound(spark):
    sizes = {"00": 382, "01": 67, "10": 3027, "11": 504}
    assert toxicity.places(sizes, 6000) == sizes
    assert toxicity.places(sizes, 2000) == {"01": 67, "00": 382, "11": 504, "10": 1047}
    assert toxicity.places(sizes, 200) == {"01": 50, "00": 50, "11": 50, "10": 50} and toxicity.places({}, 10) == {}
    rows, labels = made(16, 200)
    texts, flags, weight = toxicity.training_sample(cases.docs(spark, rows), spark.createDataFrame(labels, LABELS), toxicity.CATEGORIES, 200)
    assert len(texts) == 200 and flags.shape == (200, 2) and (weight == 1).all()
    texts, _, weight = toxicity.training_sample(cases.docs(spark, rows), spark.createDataFrame(labels, LABELS), toxicity.CATEGORIES, 120)
    assert len(texts) == 120 and abs(weight.sum() - 200) < 1e-6


def test_query_on_labelled_documents(spark, sf_dir):
    sf_dir = f"{Path(sf_dir).parent}/sf0.01"  # the smallest table has too few toxic documents to learn from
    got = {r["doc_id"]: r for r in queries.op10_toxicity_chain(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    assert len(got) == docs.count()
    assert np.mean([got[r["doc_id"]]["toxic"] == bool(r["toxic"]) for r in labels]) > 0.95


def test_edges(spark):
    rows, labels = made(15, 100)
    labels += [(0, None, None, None), (None, 1, 1, "x"), (1, 1, None, "x"), (1, 1, 0, "x"), (10**6, 0, 0, "x")]
    marked = spark.createDataFrame(labels, LABELS)
    got = toxicity.toxicity(cases.docs(spark), marked).collect()
    assert len(got) == len(cases.ROWS) and all(0 <= r[c] <= 1 for r in got for c in ("junk", "toxic"))
    assert len({r["toxic"] for r in got if r["doc_id"] in (3, 4)}) == 1
    none = spark.createDataFrame([], LABELS)
    assert all(r["toxic"] < 1e-6 for r in toxicity.toxicity(cases.docs(spark), none).collect())
    assert toxicity.toxicity(cases.empty(spark), marked).count() == 0
