"""Merkle manifest of a dataset: a content-addressed DAG from rows to one root, with a proof for every row.

A leaf is the digest of a row's columns. The leaves of one group (by default a language), in the order of their ids, form a
binary tree: every two consecutive nodes become the digest of their hex digests, a last single one the digest of itself, until
one is left, the group's root. The roots of the groups, in the order of the groups, form a tree of the same kind.

``records`` maps a digest to its children. A record covers up to ``DIGIT`` binary levels: the children of a node, their children,
and so on, level by level from the top, so that a record holds at most ``2 ** DIGIT`` nodes of its lowest level. Equal subtrees
share one record. A request for a leaf descends from the root by the digits of the leaf's rank in base ``2 ** DIGIT``: each digit
picks a way down a record, and the children it passes by are the proof. Requests travel together while their digits agree, so a
step of the descent costs one row per node that is asked for, and only the last digit one row per request. Segments come from
the top down and are reversed in the end.

Ranks come from ranges of (group, id, leaf), so a group with most of the rows is spread over all tasks, and no task holds more
than one record. Any column may be null (written ``-``); null groups and null ids come first. Rows with equal ids are ordered by
their leaves; equal rows are leaves of their own with proofs of their own. An empty table has no root and gives no proofs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import ranked, stored

#: Binary levels per record.
DIGIT = 8
#: Columns of a leaf, in order, for ``documents``.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

_LEVELS = "array<array<binary>>"
_PATH = "array<struct<sibling: binary, left: boolean>>"


def digest(value: Column) -> Column:
    return F.unhex(F.sha2(value, 256))


def said(node: Column) -> Column:
    """A digest as it is written in the digest of its parent."""
    return F.lower(F.hex(node))


def leaf(values: Sequence[Column]) -> Column:
    """Digest of values, each written as its length in bytes, a colon and itself, or ``-`` for null."""
    parts = []
    for v in values:
        text = v.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return digest(F.concat(*parts))


def depth_of(total: Column) -> Column:
    """Binary levels above ``total`` leaves."""
    return F.length(F.bin(total - 1)) - F.when(total == 1, 1).otherwise(0)


def _levels_above(nodes: Column, n: Column) -> Column:
    """``nodes`` and the ``n`` levels above them, the top first; the first has one node."""
    def up(found: Column, _: Column) -> Column:
        below = found[0]
        pairs = F.sequence(F.lit(1), F.size(below), F.lit(2))
        level = F.transform(pairs, lambda i: digest(F.concat(said(F.get(below, i - 1)), F.coalesce(said(F.get(below, i)), F.lit("")))))
        return F.concat(F.array(level), found)

    return F.aggregate(F.filter(F.sequence(F.lit(0), n), lambda k: k > 0), F.array(nodes), up)


@dataclass(frozen=True)
class Tree:
    """``records`` (digest, levels) and ``roots`` (key, root, total) of one binary tree per key."""

    records: DataFrame
    roots: DataFrame
    steps: int


def build(leaves: DataFrame) -> Tree:
    """Trees over ``leaves`` (key, rank, node, total), one per key, record by record from below."""
    spark = leaves.sparkSession
    most = leaves.agg(F.max("total")).first()[0] or 0
    level = leaves.select("key", "rank", "node", F.col("total").alias("left"), "total")
    records = spark.createDataFrame([], f"digest binary, levels {_LEVELS}")
    roots = level.filter("left = 1")
    steps = 0
    while most > 1:
        open_, place = level.filter("left > 1"), F.shiftright("rank", DIGIT)
        nodes = F.transform(F.array_sort(F.collect_list(F.struct("rank", "node"))), lambda x: x["node"])
        height = F.least(F.lit(DIGIT), depth_of(F.col("left")))
        made = open_.groupBy("key", place.alias("rank"), "left", "total").agg(nodes.alias("nodes"))
        made = stored(made.select(
            "key", "rank", "total", F.shiftright(F.col("left") + (2**DIGIT - 1), DIGIT).alias("left"),
            _levels_above(F.col("nodes"), height).alias("levels")))
        top = F.col("levels")[0][0]
        records = records.union(made.groupBy(top.alias("digest")).agg(F.any_value("levels").alias("levels")))
        level = made.select("key", "rank", top.alias("node"), "left", "total")
        roots = roots.union(level.filter("left = 1"))
        most = -(-most // 2**DIGIT)
        steps += 1
    return Tree(stored(records), roots.select("key", F.col("node").alias("root"), "total"), steps)


def _segment(levels: Column, place: Column, height: Column) -> Column:
    """The way from the top of a record down to its node ``place``: per level the child passed by, and its side."""
    def step(k: Column) -> Column:
        at = F.call_function("shiftright", place, height - k)
        left = at % 2 == 1
        return F.struct(F.get(levels[k], F.when(left, at - 1).otherwise(at + 1)).alias("sibling"), left.alias("left"))

    return F.transform(F.filter(F.sequence(F.lit(0), height.cast("int")), lambda k: k > 0), step)


def _opened(frontier: DataFrame, records: DataFrame) -> DataFrame:
    """``frontier`` (key, rank, node, height, path, ...) with the nodes at the foot of its records in place of their tops."""
    inside = F.size("levels") - 1
    return (
        frontier.join(records, frontier["node"] == records["digest"]).withColumn("__h", inside)
        .select("*", F.posexplode(F.element_at("levels", -1)).alias("__place", "__foot"))
        .withColumns({
            "rank": F.shiftleft("rank", DIGIT) + F.col("__place"), "node": F.col("__foot"), "height": F.col("height") - F.col("__h"),
            "path": F.concat("path", _segment(F.col("levels"), F.col("__place"), F.col("__h")))})
        .select(frontier.columns)
    )


@dataclass(frozen=True)
class Manifest:
    """``leaves`` (key, rank, node, total, and the columns asked for), the trees of the groups, the tree over them, the root."""

    leaves: DataFrame
    groups: Tree
    top: Tree
    top_leaves: DataFrame
    root: str | None

    @property
    def records(self) -> DataFrame:
        """``digest`` to ``levels``: what descends from it, level by level, itself first."""
        return self.groups.records.union(self.top.records)


def group_key(group: Column) -> Column:
    """A group as a string without nulls, in the order of groups: null first, then by bytes."""
    return F.coalesce(F.concat(F.lit("."), group.cast("string")), F.lit(""))


def manifest(rows: DataFrame) -> Manifest:
    """The manifest of ``rows`` (group, id, node, and further columns that stay with the leaf)."""
    keyed = stored(rows.withColumn("key", group_key(F.col("group"))).drop("group").withColumn("__tie", F.monotonically_increasing_id()))
    leaves = stored(ranked(keyed, "key", [F.col("id").asc_nulls_first(), F.col("node"), F.col("__tie")], ["__tie"]))
    groups = build(leaves)
    subroots = groups.roots.select(F.lit("").alias("key"), F.col("key").alias("group"), F.col("root").alias("node"), F.col("total").alias("size"))
    top_leaves = stored(ranked(subroots, "key", [F.col("group")]))
    top = build(top_leaves)
    found = top.roots.select(F.lower(F.hex("root"))).first()
    return Manifest(leaves, groups, top, top_leaves, found[0] if found else None)


def _passed(nodes: DataFrame, asked: DataFrame, steps: int) -> DataFrame:
    """Those of ``nodes`` that lie above a requested leaf."""
    digits = asked.select("key", "rank", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("d"))
    above = digits.select("key", F.expr(f"shiftright(rank, d * {DIGIT})").alias("rank"), (F.col("d") * DIGIT).alias("height")).distinct()
    return nodes.join(above, ["key", "rank", "height"], "left_semi").select(nodes.columns)


def proofs(made: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """Per requested leaf its columns with ``subroot``, ``root`` and ``path``: siblings from the leaf up to the root.

    ``requests`` are rows of ``made.leaves``, all by default. A level without a sibling has a null one.
    """
    asked = made.leaves if requests is None else requests
    records = made.records
    # From the root to the roots of the groups that are asked for.
    frontier = made.top.roots.select("key", F.lit(0).cast("long").alias("rank"), F.col("root").alias("node"), depth_of(F.col("total")).alias("height"), F.array().cast(_PATH).alias("path"))
    for _ in range(made.top.steps):
        frontier = _opened(frontier, records)
    groups = made.top_leaves.select(F.col("rank").alias("__rank"), F.col("group").alias("__group"), F.col("size"))
    frontier = frontier.join(groups, F.col("rank") == F.col("__rank")).select(
        F.col("__group").alias("key"), F.lit(0).cast("long").alias("rank"), "node", depth_of(F.col("size")).alias("height"), "path", F.col("node").alias("subroot"))
    # Down to the lowest records, digit by digit; only through nodes that some request passes.
    lowest = frontier.filter(F.col("height") <= DIGIT)
    for _ in range(made.groups.steps - 1):
        opened = _opened(frontier.filter(F.col("height") > DIGIT), records)
        if requests is not None:
            opened = _passed(opened, asked, made.groups.steps)
        frontier = stored(opened)
        lowest = lowest.union(frontier.filter(F.col("height") <= DIGIT))
    feet = lowest.join(records, lowest["node"] == records["digest"], "left").select(
        "key", F.col("rank").alias("__page"), "path", "subroot", "levels")
    inside = F.coalesce(F.size("levels") - 1, F.lit(0))
    place = F.pmod(F.col("rank"), F.lit(2**DIGIT)).cast("int")
    down = F.when(F.col("levels").isNull(), F.col("path")).otherwise(F.concat("path", _segment(F.col("levels"), place, inside)))
    return (
        asked.withColumn("__page", F.shiftright("rank", DIGIT)).join(feet, ["key", "__page"])
        .withColumn("path", F.reverse(down)).withColumn("subroot", said(F.col("subroot"))).withColumn("root", F.lit(made.root).cast("string"))
        .drop("levels", "__page")
    )


def folded(node: Column, path: Column) -> Column:
    """Hex digest of the root that ``node`` leads to with the siblings of ``path``."""
    def up(at: Column, step: Column) -> Column:
        other = said(step["sibling"])
        return F.sha2(F.when(other.isNull(), at).when(step["left"], F.concat(other, at)).otherwise(F.concat(at, other)), 256)

    return F.aggregate(path, said(node), up)


def proof_digest(path: Column) -> Column:
    """Hex digest of the siblings of a path, in order."""
    return F.sha2(F.array_join(F.transform(F.filter(path, lambda x: x["sibling"].isNotNull()), lambda x: said(x["sibling"])), ""), 256)


def verify_documents(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """One row per document: its leaf, its group's root, the root, its proof's digest, the root its tampered row folds to, and
    whether that is the root.

    Tampered rows have one added to ``n_chars`` (a null stays); ``tampered`` says which, by default those whose id's crc32 is
    divisible by seven.
    """
    values = {c: F.col(c) for c in LEAF_COLUMNS}
    hit = F.crc32(F.col("doc_id").cast("string")) % 7 == 0 if tampered is None else tampered
    changed = {**values, "n_chars": values["n_chars"].cast("decimal(38,0)") + 1}
    rows = docs.select(
        F.col("lang").alias("group"), F.col("doc_id").alias("id"), leaf(list(values.values())).alias("node"),
        F.when(hit, leaf(list(changed.values()))).alias("changed"))
    found = proofs(manifest(rows))
    fold = folded(F.coalesce("changed", "node"), F.col("path"))
    return found.select(
        F.col("id").alias("doc_id"), said(F.col("node")).alias("leaf"), "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
        fold.alias("folded_root"), F.size("path").cast("long").alias("n_levels"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
