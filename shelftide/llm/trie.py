"""A prefix trie of conversations, by truncation peeling.

A node is a distinct sequence of first turns (role and text) that some conversation begins with. Nodes are found from below:
at the greatest depth the conversations that end there are grouped by their turns; then the last turn is stripped, what is left
is grouped again together with the conversations that end one turn higher, and so on up to the root. Members, children, leaves
and saved tokens are summed in these groupings, so a node is complete when it is found.

- Turns get their places by ranges of (conversation, turn), so a conversation with most of the rows is spread over all tasks.
- A sequence of turns is known by the xor of 128 bits per (place, role, text): such keys of all prefixes come from running
  aggregates over blocks of ``BLOCK`` turns. Equal keys count as equal sequences.
- Conversations that are equal from start to end are merged first; their ids are sorted by ranges and hashed from chunks.
- From the first multiple of ``SEGMENT`` turns that no other sequence shares, a sequence is a chain whose numbers are known
  at once. Peeling starts there, so its rounds count shared turns only. It carries the keys of at most ``SEGMENT`` turns at a
  time and fetches the next ones from the sequence of the smallest member.
- A parent's id is joined to its children; parents of a large share of all nodes are at most ``MOST_HOT`` and are broadcast.

Null roles and texts are empty. Turns are ordered by number, null first, and turns with equal numbers by role and text. Rows
without a conversation id belong to no conversation and give no node. Repeated rows are turns of their own. An empty table has
no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import ranked, stored

#: Turns whose keys an item of the peeling carries at most.
SEGMENT = 16
#: Turns that one task runs over in order.
BLOCK = 4096
#: Parents that are broadcast at most.
MOST_HOT = 10_000

_ENDS = ("e1", "e2", "e3", "e4")
_EMPTY = hashlib.sha256(b"").hexdigest()
_MERGED = "depth long, a long, b long, last_block long, all_chars long, conv_id long, n long, e1 long, e2 long, e3 long, e4 long"


def ordered_turns(turns: DataFrame) -> DataFrame:
    """``(conv_id, rank, total, t1, t2, chars)``: turns by place, with 128 bits of role and text."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = turns.filter("conv_id IS NOT NULL").select(
        "conv_id", "turn", F.concat(role, F.lit("\0"), text).alias("said"), F.length(text).cast("long").alias("chars"),
        F.xxhash64(F.lit("1"), role, text).alias("t1"), F.xxhash64(F.lit("2"), text, role).alias("t2"))
    placed = ranked(rows, "conv_id", [F.col("turn").asc_nulls_first(), F.left("said", F.lit(64))], ["turn", "said"], [F.col("said")])
    return stored(placed)


def _blocks(df: DataFrame) -> DataFrame:
    """One row of ``df`` per block of its conversation."""
    return df.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last_block"))))


def rebuilt(rows: DataFrame, n_head: Column, base: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first ``n_head`` turns are those of conversation ``base``.

    Returns turns ``(conv_id, block, d, t1, t2, chars)``, ``d`` from 1, and conversations ``(conv_id, depth, last_block)``.
    """
    convs = rows.filter("rank = 0").select("conv_id", "total").withColumns({"h": n_head.cast("long"), "base": base})
    bases = convs.filter(F.col("conv_id") == F.col("base")).select("base", F.col("total").alias("base_total"))
    convs = convs.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_total", F.lit(0))))
    convs = stored(convs.select(
        "conv_id", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("total") - F.col("h"), F.lit(0))).alias("depth"),
        F.floor((F.col("total") - 1) / BLOCK).alias("last_block")))
    turn = ["t1", "t2", "chars"]
    heads = convs.filter("taken > 0").select("conv_id", "base", F.explode(F.sequence(F.lit(0).cast("long"), F.col("taken") - 1)).alias("rank"))
    of_bases = rows.withColumnRenamed("conv_id", "base").select("base", "rank", *turn)
    heads = heads.join(of_bases, ["base", "rank"]).select("conv_id", F.lit(0).cast("long").alias("block"), (F.col("rank") + 1).alias("d"), *turn)
    own = rows.withColumn("block", F.floor(F.col("rank") / BLOCK)).join(_blocks(convs.select("conv_id", "h", "taken", "last_block")), ["conv_id", "block"])
    own = own.filter("rank >= h").select("conv_id", "block", (F.col("taken") + F.col("rank") - F.col("h") + 1).alias("d"), *turn)
    return heads.union(own), convs.select("conv_id", "depth", "last_block")


def prefixes(turns: DataFrame) -> DataFrame:
    """``(conv_id, block, d, a, b, pa, pb, chars, chars_to)``: keys of the first ``d`` turns and of one fewer, and running lengths."""
    keyed = turns.select("conv_id", "block", "d", "chars", F.xxhash64("d", "t1", "t2").alias("x"), F.xxhash64("t2", "d", "t1").alias("y"))
    here = Window.partitionBy("conv_id", "block").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    inside = keyed.withColumns({"ia": F.bit_xor("x").over(here), "ib": F.bit_xor("y").over(here), "ic": F.sum("chars").over(here)})
    sums = keyed.groupBy("conv_id", "block").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.sum("chars").alias("c"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    start = sums.select("conv_id", "block", *[
        F.coalesce(f.over(before), F.lit(0)).alias(n) for f, n in ((F.bit_xor("x"), "sa"), (F.bit_xor("y"), "sb"), (F.sum("c"), "sc"))])
    a, b = F.col("ia").bitwiseXOR(F.col("sa")), F.col("ib").bitwiseXOR(F.col("sb"))
    return inside.join(start, ["conv_id", "block"]).select(
        "conv_id", "block", "d", a.alias("a"), b.alias("b"), a.bitwiseXOR(F.col("x")).alias("pa"), b.bitwiseXOR(F.col("y")).alias("pb"),
        "chars", (F.col("ic") + F.col("sc")).alias("chars_to"))


_CHUNK = "depth long, a long, b long, last_block long, all_chars long, first long, n long, ids string"


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ends to one row per key and batch, with the ids as text."""
    schema = pa.schema([*[(c, pa.int64()) for c in ("depth", "a", "b", "last_block", "all_chars", "first", "n")], ("ids", pa.string())])
    for batch in batches:
        rows: list[list] = []
        for depth, a, b, conv, last, chars in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if rows and rows[-1][:3] == [depth, a, b]:
                rows[-1][6] += 1
                rows[-1][7].append(str(conv))
            else:
                rows.append([depth, a, b, last, chars, conv, 1, [str(conv)]])
        if rows:
            columns = [list(c) for c in zip(*rows, strict=True)]
            columns[7] = [",".join(ids) for ids in columns[7]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks in order to one row per key, with the digest of all ids as four numbers."""
    names = ["depth", "a", "b", "last_block", "all_chars", "conv_id", "n", *_ENDS]
    now: list | None = None
    digest = hashlib.sha256()

    def made(done: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*done, strict=True)], names)

    for batch in batches:
        done: list[list] = []
        for *row, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if now and now[:3] == row[:3]:
                now[6] += row[6]
                digest.update(b"," + ids.encode())
                continue
            if now:
                done.append([*now, *struct.unpack(">4q", digest.digest())])
            now, digest = row, hashlib.sha256(ids.encode())
        if done:
            yield made(done)
    if now:
        yield made([[*now, *struct.unpack(">4q", digest.digest())]])


def merged(ends: DataFrame) -> DataFrame:
    """Equal conversations as one: ``ends`` (depth, a, b, conv_id, last_block, all_chars) grouped by their turns.

    ``conv_id`` is the smallest of ``n``, with its block count; ``e1`` to ``e4`` are the SHA-256 of the ids in order.
    """
    key = ["depth", "a", "b"]
    chunks = ends.repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id").mapInArrow(_chunks, _CHUNK)
    return stored(chunks.repartition(*key).sortWithinPartitions(*key, "first").mapInArrow(_hashed, _MERGED))


def _grouped(items: DataFrame) -> DataFrame:
    """Items with equal paths become a node each."""
    own = F.element_at("path", -1)["chars"]
    n = F.sum("n")
    return items.groupBy("path").agg(
        F.min("conv_id").alias("conv_id"), n.alias("n"), F.sum("kids").alias("kids"),
        F.when(F.sum("kids") == 0, F.lit(1).cast("long")).otherwise(F.sum("leaves")).alias("leaves"), F.sum("saved").alias("below"),
        *[F.max(e).alias(e) for e in _ENDS],
    ).withColumn("saved", F.col("below") + (F.col("n") - 1) * own).drop("below")


def _stripped(nodes: DataFrame) -> DataFrame:
    """The nodes as items of their parents."""
    shorter = F.slice("path", F.lit(1), F.size("path") - 1)
    return nodes.select(shorter.alias("path"), "conv_id", "n", F.lit(1).cast("long").alias("kids"), "leaves", "saved", *[F.lit(None).cast("long").alias(e) for e in _ENDS])


def _emitted(nodes: DataFrame, depth: int) -> DataFrame:
    at, up = F.element_at("path", -1), F.get("path", F.size("path") - 2)
    return nodes.select(
        F.lit(depth).cast("long").alias("depth"), at["a"].alias("a"), at["b"].alias("b"), up["a"].alias("pa"), up["b"].alias("pb"), "conv_id",
        F.col("n").alias("n_convs"), F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), *_ENDS)


def nodes_of(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Nodes of the trie of conversations given as :func:`rebuilt` gives them, without their parents' ids."""
    zero = F.lit(0).cast("long")
    rows = stored(prefixes(turns))
    last = rows.join(_blocks(convs), ["conv_id", "block"]).filter("d = depth").select("depth", "a", "b", "conv_id", "last_block", F.col("chars_to").alias("all_chars"))
    none = convs.filter("depth = 0").select("depth", zero.alias("a"), zero.alias("b"), "conv_id", "last_block", zero.alias("all_chars"))
    ends = merged(last.union(none))

    of_one = rows.join(_blocks(ends.select("conv_id", "n", "depth", "last_block", "all_chars", *_ENDS)), ["conv_id", "block"])
    of_one = stored(of_one)
    alone = of_one.filter((F.col("d") % SEGMENT == 0) & (F.col("d") < F.col("depth"))).groupBy("d", "a", "b").agg(
        F.count(F.lit(1)).alias("sequences"), F.min("conv_id").alias("conv_id"), F.min("last_block").alias("last_block"))
    cuts = stored(alone.filter("sequences = 1").groupBy("conv_id", "last_block").agg(F.min("d").alias("cut")))
    of_one = of_one.join(_blocks(cuts).drop("last_block"), ["conv_id", "block"], "left").withColumn("cut", F.coalesce("cut", "depth"))

    ended = F.col("d") == F.col("depth")
    found = [of_one.filter("d > cut").select(
        F.col("d").alias("depth"), "a", "b", "pa", "pb", "conv_id", F.col("n").alias("n_convs"), (~ended).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), ((F.col("n") - 1) * (F.col("all_chars") - F.col("chars_to") + F.col("chars"))).alias("saved_tokens"),
        *[F.when(ended, F.col(e)).alias(e) for e in _ENDS])]

    # Keys of up to SEGMENT turns, after the key of what stands before them.
    segment = F.floor((F.col("d") - 1) / SEGMENT)
    element = lambda a, b, chars: F.struct(F.col(a).alias("a"), F.col(b).alias("b"), chars.alias("chars"))
    listed = F.array_sort(F.collect_list(F.struct("d", element("a", "b", F.col("chars")).alias("x"))))
    segments = of_one.filter("d <= cut").groupBy("conv_id", segment.alias("segment")).agg(
        F.min_by(element("pa", "pb", zero), "d").alias("base"), listed.alias("listed"),
        F.max_by(F.struct("d", "n", "depth", "cut", (F.col("all_chars") - F.col("chars_to")).alias("rest"), *_ENDS), "d").alias("at"))
    segments = stored(segments.select(
        "conv_id", "segment", F.concat(F.array("base"), F.transform("listed", lambda x: x["x"])).alias("path"), "at"))
    whole = F.col("at.cut") == F.col("at.depth")
    items = segments.filter("at.d = at.cut").select(
        "segment", "path", "conv_id", F.col("at.n").alias("n"), (~whole).cast("long").alias("kids"), (~whole).cast("long").alias("leaves"),
        F.when(whole, zero).otherwise((F.col("at.n") - 1) * F.col("at.rest")).alias("saved"), *[F.when(whole, F.col(f"at.{e}")).alias(e) for e in _ENDS])
    items = stored(items)

    deepest = items.agg(F.max(F.col("segment") * SEGMENT + F.size("path") - 1)).first()[0] or 0
    carried = None
    for depth in range(deepest, 0, -1):
        at, place = divmod(depth - 1, SEGMENT)
        entering = items.filter((F.col("segment") == at) & (F.size("path") == place + 2)).drop("segment")
        if carried is not None and place == SEGMENT - 1:
            onward = segments.filter(F.col("segment") == at).select("conv_id", "path")
            carried = carried.drop("path").join(onward, "conv_id").select(entering.columns)
        nodes = stored(_grouped(entering if carried is None else entering.union(carried)))
        found.append(_emitted(nodes, depth))
        carried = _stripped(nodes)
    empty = F.array(F.struct(zero.alias("a"), zero.alias("b"), zero.alias("chars")))
    root = ends.filter("depth = 0").select(empty.alias("path"), "conv_id", "n", zero.alias("kids"), zero.alias("leaves"), zero.alias("saved"), *_ENDS)
    found.append(_emitted(_grouped(root if carried is None else root.union(carried)), 0))
    return stored(reduce(DataFrame.union, found))


def with_parents(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``parent_conv_id``."""
    many = max(100, nodes.count() // MOST_HOT)
    up = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    key = ["depth", "pa", "pb"]
    # A node has one parent, so fewer than nodes / many parents have more than ``many`` children.
    hot = F.broadcast(up.filter(F.col("n_children") > many).select(*key, "parent_conv_id"))
    of_hot = nodes.join(hot, key)
    rest = nodes.join(hot.drop("parent_conv_id"), key, "left_anti").filter("depth > 0")
    rest = rest.join(up.filter((F.col("n_children") > 0) & (F.col("n_children") <= many)).select(*key, "parent_conv_id"), key)
    top = nodes.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    columns = [*nodes.columns, "parent_conv_id"]
    return of_hot.select(columns).union(rest.select(columns)).union(top.select(columns))


def prefix_trie(turns: DataFrame, n_head: Column | None = None, base: Column | None = None) -> DataFrame:
    """The trie of ``turns`` (conv_id, turn, role, text): one row per node.

    The first ``n_head`` turns of every conversation are replaced by the first ones of conversation ``base`` (expressions of
    ``conv_id``; none and itself by default).
    """
    rows = ordered_turns(turns.withColumn("conv_id", F.col("conv_id").cast("long")))
    nodes = with_parents(nodes_of(*rebuilt(rows, F.lit(0) if n_head is None else n_head, F.col("conv_id") if base is None else base)))
    words = F.concat(*[F.lpad(F.lower(F.hex(e)), 16, "0") for e in _ENDS])
    return nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce(words, F.lit(_EMPTY)).alias("ends_sha256"))
