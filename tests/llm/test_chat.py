import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from shelftide.llm import chat, queries

TURNS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
    T.StructField("formatted", T.StringType()), T.StructField("start", T.StringType())])

texts = st.lists(st.sampled_from(["[INST]", "[/INST]", "</s>", "[SYS]", "[/SYS]", "[TURN]", "[:]", "[/TURN]", "\\", "[", "<", "a", "/s>", "\n", "é"]), max_size=8).map("".join)
roles = st.one_of(st.sampled_from(["user", "assistant", "system", "tool", ""]), texts)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(roles, texts), max_size=5))
def test_conversations_read_back(turns):
    assert chat.parse("".join(chat.format_turn(r, t) for r, t in turns)) == turns


def test_plain_text_is_left_as_it_is():
    assert chat.format_turn("assistant", "a [x] <b> \\ c") == "a [x] <b> \\ c</s>"


def want(rows):
    convs = {}
    for c, t, r, x, *_ in sorted(rows, key=lambda r: tuple((v is not None, v) for v in r[:4])):
        convs.setdefault(c, []).append((r or "", x or ""))
    out = {}
    for c, turns in convs.items():
        said = "".join(x for r, x in turns if r == "assistant")
        formatted = "".join(chat.format_turn(r, x) for r, x in turns)
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest(), len(formatted))
    return out


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    got = {r[0]: tuple(r)[1:] for r in queries.op5_chat_format(spark, sf_dir).collect()}
    assert got == want(rows)


def test_edges(spark):
    rows = [(1, 0, "user", "q", "x", "y"), (1, 1, "assistant", None, "x", "y"), (1, 1, "assistant", "a", "x", "y"), (1, 1, "assistant", "a", "x", "y"), (None, 0, None, None, "x", "y"),
            (2, None, "assistant", "b" * 200_000, "x", "y"), (2, 0, "", "", "x", "y"), (3, 0, "assistant", "", "x", "y")]
    formatted = chat.format_turns(spark.createDataFrame(rows, TURNS))
    assert {r[0]: tuple(r)[1:] for r in chat.conversation_digests(formatted).collect()} == want(rows)
    whole = {}
    for r in sorted(chat.conversation_starts(formatted).collect(), key=lambda r: (str(r["conv_id"]), r["start"])):
        assert r["start"] == len(whole.setdefault(r["conv_id"], "")) 
        whole[r["conv_id"]] += r["formatted"]
    assert {c: len(t) for c, t in whole.items()} == {c: v[4] for c, v in want(rows).items()}
    empty = chat.format_turns(spark.createDataFrame([], TURNS))
    assert chat.conversation_digests(empty).count() == chat.conversation_starts(empty).count() == 0
