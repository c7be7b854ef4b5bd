import random

from pyspark.sql import types as T

from shelftide.llm import decontam, queries

from . import cases

ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])


def brute(item, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row), row.index(min(row))


def test_passage_distance_equals_brute_force():
    rng = random.Random(7)
    for _ in range(1500):
        item = [rng.randint(0, 4) for _ in range(rng.randint(1, 9))]
        text = [rng.randint(0, 4) for _ in range(rng.randint(0, 25))]
        assert decontam.passage_distance(item, text) == brute(item, text)
        distance, start, end = decontam.best_passage(item, text)
        assert brute(item, text[start:end])[0] == distance


def planted(seed, n_items=60, n_docs=400):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 4))) for _ in range(3000)]
    common = words[:20]
    pick = lambda: rng.choice(common) if rng.random() < 0.4 else rng.choice(words)
    items = [[pick() for _ in range(rng.randint(5, 70))] for _ in range(n_items)]
    docs = []
    for _ in range(n_docs):
        text = [pick() for _ in range(rng.randint(0, 300))]
        if rng.random() < 0.6:
            t = list(rng.choice(items))
            for _ in range(rng.randint(0, decontam.most_edits(len(t)))):
                at = rng.randrange(len(t))
                rng.choice([lambda: t.__setitem__(at, "zz"), lambda: t.insert(at, "zz"), lambda: t.pop(at)])()
            at = rng.randint(0, len(text))
            text[at:at] = t
        docs.append(text)
    return items, docs


def test_recall_against_brute_force(spark):
    items, docs = planted(8)
    want = {(d, k) for d, t in enumerate(docs) for k, i in enumerate(items) if brute(i, t)[0] <= decontam.most_edits(len(i))}
    table = spark.createDataFrame([(k, " ".join(i).upper()) for k, i in enumerate(items)], ITEMS)
    frame = cases.docs(spark, [cases.row(d, " ".join(t)) for d, t in enumerate(docs)])
    rows = decontam.contaminations(frame, table).collect()
    got = {(r["doc_id"], r["item_id"]) for r in rows}
    assert got <= want and len(got) >= 0.99 * len(want)
    for r in rows:
        passage = docs[r["doc_id"]][r["start"]:r["end"]]
        assert brute(items[r["item_id"]], passage)[0] == r["distance"] <= decontam.most_edits(r["n_words"])
    clean = {r["doc_id"] for r in decontam.clean_documents(frame, table).collect()}
    assert clean == set(range(len(docs))) - {d for d, _ in got}


def test_recall_of_each_length(monkeypatch):
    """Many short items do not hide the loss of a few long ones."""
    rng = random.Random(11)
    words = [f"w{k}" for k in range(5000)]
    items = [[rng.choice(words) for _ in range(n)] for n in [12] * 150 + [70] * 20 + [400] * 20]
    index = decontam.Index(list(enumerate(items)))
    texts, wanted = [], []
    for k in [*range(150), *list(range(150, 190)) * 4]:
        t = list(items[k])
        for at in sorted(rng.sample(range(len(t)), decontam.most_edits(len(t))), reverse=True):
            rng.choice([lambda: t.__setitem__(at, "zz"), lambda: t.insert(at, "zz"), lambda: t.pop(at)])()
        t = ["zz"] * rng.randint(0, 400) + t + ["zz"] * 30
        texts.append([index.vocabulary.get(w, 0) for w in t])
        wanted.append((k, decontam.passage_distance(items[k], t)[0]))
    got = {(d, k): distance for d, k, distance, _, _ in index.hits(texts)}
    for n in (12, 70, 400):
        mine = [(d, k, distance) for d, (k, distance) in enumerate(wanted) if len(items[k]) == n]
        assert all(got.get((d, k), distance) == distance for d, k, distance in mine)
        assert sum((d, k) in got for d, k, _ in mine) >= 0.975 * len(mine), n
    assert all(c.reached >= decontam.RECALL for c in index.classes)
    monkeypatch.setattr(decontam, "MOST_WALKS", 0)
    exact = decontam.Index(list(enumerate(items)))
    assert {(d, k) for d, k, *_ in exact.hits(texts)} >= {(d, k) for d, (k, _) in enumerate(wanted)}


def test_given_tables_equal_brute_force(spark, sf_dir):
    read = lambda name, key: {r[0]: decontam.words_of(r[1]) for r in spark.read.parquet(f"{sf_dir}/{name}.parquet").select(key, "text").collect()}
    docs, items = read("documents", "doc_id"), read("benchmark", "item_id")
    want = {}
    for k, item in items.items():
        own, most = set(item), decontam.most_edits(len(item))
        for d, t in docs.items():
            if item and sum(w in own for w in t) >= len(item) - most and decontam.passage_distance(item, t)[0] <= most:
                want.setdefault(len(item).bit_length(), set()).add((d, k))
    got = {tuple(r) for r in queries.op3_benchmark_decontamination(spark, sf_dir).select("doc_id", "item_id").collect()}
    assert want and got <= set().union(*want.values())
    for pairs in want.values():
        assert len(pairs & got) >= 0.99 * len(pairs)


def test_blocks_give_the_same(spark, sf_dir, monkeypatch):
    want = sorted(map(tuple, queries.op3_benchmark_decontamination(spark, sf_dir).select("doc_id", "item_id", "distance").collect()))
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 4000)
    got = sorted(map(tuple, queries.op3_benchmark_decontamination(spark, sf_dir).select("doc_id", "item_id", "distance").collect()))
    assert want == got and want


def test_edges(spark):
    items = [(1, "this long sentence stands here for the first time"), (1, "this long sentence stands here for the first time"), (2, None), (3, ""), (None, "text without an ID"), (4, "zebra")]
    table = spark.createDataFrame(items, ITEMS)
    got = decontam.contaminations(cases.docs(spark), table).select("doc_id", "item_id").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, 1)] * 4 + [(2, 1)] * 2 + [(None, None)], key=str)
    clean = decontam.clean_documents(cases.docs(spark), table)
    assert clean.columns == cases.DOCS.names and clean.count() == len(cases.ROWS) - 4
    assert decontam.contaminations(cases.empty(spark), table).count() == 0
    assert decontam.clean_documents(cases.docs(spark), spark.createDataFrame([], ITEMS)).count() == len(cases.ROWS)
