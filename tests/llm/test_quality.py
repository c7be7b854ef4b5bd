import random

from shelftide.llm import quality, queries

from . import cases, oracle


def test_query_equals_sql(spark, sf_dir):
    assert oracle.difference(spark, sf_dir, "op6_quality_rules") is None


def made(seed):
    rng = random.Random(seed)
    rows = []
    for k in range(900):
        words = [rng.choice("ab cd# ef | gh$ ij Kl MN".split()) + str(rng.randint(0, 40)) for _ in range(rng.randint(0, 60))]
        text = "".join(w + rng.choice([" ", "  ", "\n", "\t", "\n\n"]) for w in words * rng.choice([1, 1, 1, 2]))
        rows.append(cases.row(k, text, rng.choice(["en", "de", None]), rng.choice(["a", "a", "a", "b", "c", None])))
    return rows


def test_random_tables_equal_sql(spark, tmp_path):
    assert oracle.difference_of(cases.docs(spark, made(9)), tmp_path, "op6_quality_rules") is None


def test_thresholds_follow_the_group(spark):
    clean = "one two three four five six seven eight nine ten eleven twelve"
    odd = " ".join(w + "#" for w in clean.split())
    rows = [cases.row(k, clean, "en", "a") for k in range(300)] + [cases.row(1000, odd, "en", "a")]
    rows += [cases.row(2000 + k, odd if k % 2 else clean, "en", "forum") for k in range(300)]
    got = {r["doc_id"]: r["kept"] for r in quality.quality_report(cases.docs(spark, rows)).collect()}
    assert not got[1000] and all(v for k, v in got.items() if k != 1000)


def test_edges(spark, tmp_path):
    frame = cases.docs(spark)
    assert oracle.difference_of(frame.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), tmp_path, "op6_quality_rules") is None
    rows = quality.quality_report(frame).collect()
    assert len(rows) == len(cases.ROWS) and all(r["base_failed"] and r["n_words"] == 0 for r in rows if r["doc_id"] in (3, 4, 7))
    kept = quality.quality_filter(frame)
    assert kept.columns == cases.DOCS.names and sorted(r["doc_id"] for r in kept.collect() if r["doc_id"]) == [1, 1, 2, 5, 6]
    assert quality.quality_filter(cases.empty(spark)).count() == quality.quality_report(cases.empty(spark)).count() == 0


def test_native_plan(spark, sf_dir):
    plan = queries.op6_quality_rules(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
