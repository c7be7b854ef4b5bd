import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import types as T

from shelftide.llm import queries, trie

from . import oracle

TURNS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
    # Names that the operator uses for its own columns.
    *[T.StructField(n, T.StringType()) for n in ("path", "n", "depth", "block", "rank", "said", "kids")]])


def turns(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 7) for r in rows], TURNS).repartition(3)


def want(rows, rebuild=True):
    """The trie, node by node from all members."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    members = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if rebuild else 0
        whole = own.get(c - int(math.fmod(c, 100)), [])[:h] + mine[h:]
        for d in range(len(whole) + 1):
            members.setdefault(tuple(whole[:d]), []).append((c, d == len(whole)))
    kids, leaves, saved = {}, {}, {}
    for key in sorted(members, key=len, reverse=True):
        leaves.setdefault(key, 0)
        leaves[key] += 0 if kids.get(key) else 1
        saved[key] = saved.get(key, 0) + (len(members[key]) - 1) * (len(key[-1][1]) if key else 0)
        if key:
            for counts, n in ((kids, 1), (leaves, leaves[key]), (saved, saved[key])):
                counts[key[:-1]] = counts.get(key[:-1], 0) + n
    out = []
    for key, found in members.items():
        ids = ",".join(str(c) for c in sorted(c for c, end in found if end))
        parent = min(c for c, _ in members[key[:-1]]) if key else None
        out.append((min(c for c, _ in found), len(key), parent, len(found), kids.get(key, 0), leaves[key], saved[key], hashlib.sha256(ids.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_equals_sql(spark, sf_dir):
    assert oracle.difference(spark, sf_dir, "op13_conversation_trie") is None


def test_query_equals_members(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.op13_conversation_trie(spark, sf_dir)) == want(rows)


@pytest.mark.parametrize("limits", [{}, {"SEGMENT": 2, "BLOCK": 3, "MOST_HOT": 1}])
def test_random_conversations(spark, monkeypatch, limits):
    """Few different turns, so that many conversations share beginnings, whole texts and ends; some are long."""
    for name, value in limits.items():
        monkeypatch.setattr(trie, name, value)
    rng = random.Random(5)
    rows = []
    for c in [*range(60), *range(100, 140)]:
        for k in range(rng.choice([1, 2, 3, 5, 9])):
            rows.append((c, k, rng.choice("ab"), rng.choice(["", "x", "yy"])))
    long = [(k, "user", f"t{k}") for k in range(23)]
    rows += [(1000 + c, k, r, t) for c in range(4) for k, r, t in long[: 23 - c // 2]]
    assert got(trie.prefix_trie(turns(spark, rows))) == want(rows, rebuild=False)


def test_edges(spark, tmp_path):
    rows = [
        (1, 0, "user", "q"), (1, 1, None, None), (1, 1, "assistant", "b"), (1, 1, "assistant", "a"), (1, 1, "assistant", "a"), (1, None, "user", "first"),
        (2, 0, "user", "x" * 300_000), (2, 1, "assistant", ""), (None, 0, "user", "nobody's"), (-5, 0, "user", "q"), (-5, 1, "", "é😀"), (300, 0, "user", "q"),
        (0, 0, "system", "s"), (0, 1, "user", "t"), (777, 0, "user", "short")]
    table = turns(spark, rows)
    table.write.parquet(f"{tmp_path}/conversations.parquet")
    assert got(queries.op13_conversation_trie(spark, str(tmp_path))) == want(rows)
    assert got(trie.prefix_trie(table)) == want(rows, rebuild=False)
    assert trie.prefix_trie(turns(spark, [])).count() == 0
    assert trie.prefix_trie(turns(spark, [(None, 1, "a", "b")])).count() == 0
    turnless = [r for r in got(queries.op13_conversation_trie(spark, str(tmp_path))) if r[1] == 0]
    assert len(turnless) == 1 and turnless[0][3] == 6


def test_ids_of_many_copies(spark, monkeypatch):
    """Ids of one sequence from several tasks are hashed in order."""
    rows = [(c, 0, "user", "same") for c in range(5000)] + [(c, 0, "user", "other") for c in range(5000, 5020)]
    assert got(trie.prefix_trie(turns(spark, rows).repartition(9))) == want(rows, rebuild=False)
