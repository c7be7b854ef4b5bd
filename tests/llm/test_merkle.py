import hashlib
import zlib

from pyspark.sql import functions as F

from shelftide.llm import merkle, queries

from . import cases, oracle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    said = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return sha("".join(said))


def climb(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i:i + 2])) for i in range(0, len(below), 2)])
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        out.append((level[i ^ 1] if i ^ 1 < len(level) else None, i % 2))
        i //= 2
    return out


def want(rows):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) per row, the plain way."""
    langs = {}
    for doc_id, text, lang, source, n_chars in rows:
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and n_chars is not None
        changed = leaf(doc_id, source, lang, n_chars + 1, text) if hit else leaf(doc_id, source, lang, n_chars, text)
        langs.setdefault(lang, []).append(((doc_id is not None, doc_id), leaf(doc_id, source, lang, n_chars, text), changed))
    order = sorted(langs, key=lambda k: (k is not None, (k or "").encode()))
    trees = {k: climb([x[1] for x in sorted(langs[k])]) for k in order}
    top = climb([trees[k][-1][0] for k in order])
    out = []
    for g, k in enumerate(order):
        for i, ((_, doc_id), own, changed) in enumerate(sorted(langs[k])):
            path = siblings(trees[k], i) + siblings(top, g)
            at = changed
            for other, right in path:
                at = sha(at if other is None else other + at if right else at + other)
            out.append((doc_id, own, trees[k][-1][0], top[-1][0], sha("".join(s for s, _ in path if s)), at, at == top[-1][0]))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


def test_query_equals_sql(spark, sf_dir):
    assert oracle.difference(spark, sf_dir, "op11_merkle_manifest") is None


def test_query_equals_plain_trees(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    found = got(queries.op11_merkle_manifest(spark, sf_dir))
    assert found == want(rows)
    assert 0 < sum(not r[-1] for r in found) < len(found)


def test_deep_trees(spark):
    """More than two digits: a hot language beside a lone document and groups at the border of a record."""
    rows = [(k, f"t{k}", "en", "s", k) for k in range(66_000)]
    rows += [(100_000 + k, "x", lang, None, k) for lang, n in (("aa", 1), ("bb", 256), ("cc", 257), (None, 3)) for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    assert got(merkle.verify_documents(docs)) == want(rows)


def test_edges(spark):
    rows = [r[:5] for r in cases.ROWS]
    assert got(merkle.verify_documents(cases.docs(spark))) == want(rows)
    assert merkle.verify_documents(cases.empty(spark)).count() == 0
    lone = merkle.verify_documents(cases.docs(spark, [cases.ROWS[0]])).first()
    assert lone["leaf"] == lone["subroot"] == lone["root"] and lone["proof_sha256"] == sha("")


def test_requests_and_records(spark):
    """Proofs for some leaves alone; every record hashes to its key."""
    rows = spark.range(3000).select(
        F.lit("en").alias("group"), F.col("id"), merkle.leaf([F.col("id")]).alias("node"))
    made = merkle.manifest(rows)
    every = {r["id"]: r["path"] for r in merkle.proofs(made).collect()}
    some = merkle.proofs(made, made.leaves.filter("id % 500 = 7")).collect()
    assert {r["id"]: r["path"] for r in some} == {k: every[k] for k in range(7, 3000, 500)}
    for r in made.records.collect():
        assert bytes(r["levels"][0][0]) == bytes(r["digest"])
        for above, below in zip(r["levels"], r["levels"][1:], strict=False):
            assert [x.hex() for x in above] == climb([x.hex() for x in below])[1]
