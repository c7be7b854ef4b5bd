import hashlib
import random
import re

from shelftide.llm import queries, secrets

from . import cases

_RULES = (
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII), 2, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16), ("hex", re.compile(r"[0-9a-f]+"), 0, 32),
)


def plain(text):
    found = []
    for order, (kind, rule, group, least) in enumerate(_RULES):
        found += [(m.start(), order, f"{kind}:{m.start()}:{m.end()}") for m in rule.finditer(text or "") if len(m[group]) >= least]
    return [x[2] for x in sorted(found)]


def said(spans):
    return [f"{secrets.KINDS[k]}:{a}:{b}" for k, a, b, _ in sorted(spans, key=lambda s: (s[1], s[0]))]


def test_base_spans_equal_plain_rules():
    rng = random.Random(1)
    parts = ["token", "TOKEN", "api_key", "apikey", "=", ":", " ", '"', "'", "AKIA", "ABCD1234", "deadbeef", "0123456789abcdef", "x", "é", "\n", "ſecret", "secret=", "passwd : "]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert said(secrets.base_spans(text)) == plain(text), text


def test_automaton_merges_and_prefers_its_format():
    rng = random.Random(2)
    hexes = ["".join(rng.choices("0123456789abcdef", k=40)) for _ in range(200)]
    words = ["".join(rng.choices(["tion", "keit", "and", "the", "er"], k=5)) for _ in range(200)]
    fmt, ordinary = secrets.Automaton(hexes), secrets.Automaton(words)
    assert secrets.format_score("".join(rng.choices("0123456789abcdef", k=24)), [fmt], ordinary) > secrets.THRESHOLD
    assert secrets.format_score("keittionandthe2er", [fmt], ordinary) < secrets.THRESHOLD
    same = secrets.Automaton(["ab" * k for k in range(1, 30)] * 5)
    reached = {0}
    while new := {x for r in reached for x in same.next[r].values()} - reached:
        reached |= new
    assert len(reached) < 10  # the prefix tree has 59 states


def test_query_over_all_texts(spark, sf_dir):
    got = {r["doc_id"]: r for r in queries.op1_secret_scan(spark, sf_dir).collect()}
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for doc_id, text in rows:
        want = plain(text)
        assert got[doc_id]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(filter(None, got[doc_id]["spans"].split(",")))
        assert [got[doc_id][f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(w.startswith(k) for w in want) for k in ("assign", "access", "hex")]


def test_learned_format_is_added(spark):
    rng = random.Random(3)
    made = lambda n: "".join(rng.choices("0123456789abcdef", k=n))
    rows = [cases.row(k, f"the keitschaftundtionande words token = {made(40)} and ereintionkeitschaft") for k in range(80)]
    hidden = made(24)
    rows.append(cases.row(1000, f"nothing says what {hidden} is, mail2.example.com neither"))
    got = {r["doc_id"]: r["secrets"] for r in secrets.find_secrets(cases.docs(spark, rows)).collect()}
    assert [(s["kind"], s["value"]) for s in got[1000]] == [(3, hidden)]
    assert all([s["kind"] for s in got[k]] == [0, 2] for k in range(80))


def test_formats_come_from_every_credential(spark, monkeypatch):
    rng = random.Random(4)
    tokens = ["".join(rng.choices("ABCDEFGHxyz", k=rng.randint(10, 14))) for _ in range(650)] + ["zz-" + "".join(rng.choices("01", k=9)) for _ in range(60)]
    words = ["".join(rng.choices(["tion", "keit", "and", "the", "er"], k=8)) for _ in range(500)]
    rows = [cases.row(k, f"{words[k % 500]} says token = {t} today") for k, t in enumerate(tokens)]
    found = secrets.scan(cases.docs(spark, rows))
    for share in (secrets.SHARE, 0.5):  # states that few strings reach join others; no string is left out
        monkeypatch.setattr(secrets, "SHARE", share)
        formats, ordinary = secrets.learn(found)
        assert len(formats) == 1
        for got, strings in ((formats[0], set(tokens)), (ordinary, set(words))):
            want = secrets.Automaton(sorted(strings))
            assert sum(got.ends) == len(strings)
            assert sum(got.count) == sum(len(s) + 1 for s in strings)
            assert (got.next, got.count, got.ends, got.passed) == (want.next, want.count, want.ends, want.passed)


def test_edges(spark):
    got = [(r["doc_id"], [s["kind"] for s in r["secrets"]]) for r in secrets.find_secrets(cases.docs(spark)).collect()]
    assert len(got) == len(cases.ROWS) and (9, [0, 2, 1]) in got and (3, []) in got and (None, []) in got
    assert secrets.find_secrets(cases.empty(spark)).count() == 0
