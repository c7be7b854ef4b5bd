import random

from shelftide.llm import line_dedup

from . import cases, oracle


def test_query_equals_sql(spark, sf_dir):
    assert oracle.difference(spark, sf_dir, "op8_line_dedup") is None


def test_random_tables_equal_sql(spark, tmp_path):
    rng = random.Random(10)
    lines = [f"line {k}" for k in range(30)] + ["", "  ", " line 1 ", "\tline 2"]
    rows = [cases.row(k, "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 6))), "en", rng.choice([*"abcdefg", None])) for k in range(150)]
    assert oracle.difference_of(cases.docs(spark, rows), tmp_path, "op8_line_dedup") is None


def test_threshold_is_exact(spark):
    """Sketches decide far from the threshold, exact counts near it; many sites and few both come out right."""
    rows = []
    for n in (line_dedup.MIN_SITES - 1, line_dedup.MIN_SITES, 3 * line_dedup.MIN_SITES):
        rows += [cases.row(1000 * n + k, f"on {n} sites\nonly here {n} {k}", "en", f"site{k}") for k in range(n)]
    rows += [cases.row(90_000 + k, "on one site", "en", "site") for k in range(200)]
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(cases.docs(spark, rows)).collect()}
    for r in rows:
        n, k = divmod(r[0], 1000)
        gone = n in (line_dedup.MIN_SITES, 3 * line_dedup.MIN_SITES) and k > 0
        assert got[r[0]]["text"] == (r[1].split("\n")[1] if gone else r[1])
        assert got[r[0]]["__lines"]["removed"] == gone


def test_edges(spark):
    rows = [*cases.ROWS, *[cases.row(20 + k, cases.SENTENCE, "en", f"s{k}") for k in range(5)]]
    out = line_dedup.dedup_lines(cases.docs(spark, rows))
    assert out.drop("__lines").columns == cases.DOCS.names
    got = out.collect()
    assert len(got) == len(rows)
    assert sorted(r["doc_id"] for r in got if r["text"] == cases.SENTENCE) == [1, 1]  # rows alike in id and text are treated alike
    assert [r["text"] for r in got if r["doc_id"] == 3] == [None] and [r["text"] for r in got if r["doc_id"] == 7] == [" \t\n\x0b\r "]
    assert line_dedup.dedup_lines(cases.empty(spark)).count() == 0
