"""Boilerplate lines: those that stand on many sites.

Per line hash: a HyperLogLog sketch of the sites it stands on, merged by aggregation. An estimate between
``min_sites / 2`` and ``2 * min_sites`` is settled by an exact count of distinct sites; estimates beyond are clear.
Of a boilerplate line the first copy in the table, by document and line number, stays; the rest go.
So a text that was copied whole to many sites survives once.

Lines are parts between ``\\n``, compared after trimming white space; lines without a word are never removed. Null text
has no lines and stays null. Null sites count as one site. Rows with the same id and text are treated alike; a null id
comes before all others. Only the ids and numbers of removed lines are shuffled besides the texts themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import SPACE, stored

MIN_SITES = 5
LG_K = 11


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _occurrences(docs: DataFrame, site: str) -> DataFrame:
    """One row per line with a word: key of its document, number, hash, site."""
    trimmed = F.regexp_replace("line", f"^{SPACE}+|{SPACE}+$", "")
    return (
        docs.filter(F.col("text").isNotNull())
        .select("doc_id", F.xxhash64("text").alias("text_key"), F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site"), F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
        .withColumn("line", trimmed).filter("line <> ''")
        .select("doc_id", "text_key", "site", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("line"), "line").alias("h2"))
    )


def boilerplate(occurrences: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``(h1, h2, first)`` of every line on ``min_sites`` sites or more; ``first`` is the copy that stays."""
    key = ["h1", "h2"]
    spread = stored(
        occurrences.groupBy(*key).agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_K))).alias("sites"),
            F.min(F.struct("doc_id", "text_key", "pos")).alias("first"), F.count(F.lit(1)).alias("n"),
        ).filter((F.col("n") >= min_sites) & (F.col("sites") * 2 > min_sites))
    )
    clear = spread.filter(F.col("sites") >= 2 * min_sites)
    near = spread.filter(F.col("sites") < 2 * min_sites)
    exact = (
        occurrences.join(near.select(*key), key).select(*key, "site").distinct()
        .groupBy(*key).agg(F.count(F.lit(1)).alias("exact")).filter(F.col("exact") >= min_sites)
    )
    return stored(clear.select(*key, "first").union(near.join(exact, key).select(*key, "first")))


def removed_lines(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``(doc_id, text_key, gone)``: the numbers of the lines to remove, for documents that have any."""
    found = stored(_occurrences(docs, site))
    here = F.struct("doc_id", "text_key", "pos")
    return (
        found.join(boilerplate(found, min_sites), ["h1", "h2"]).filter(~here.eqNullSafe(F.col("first")))
        .select("doc_id", "text_key", "pos").distinct()
        .groupBy("doc_id", "text_key").agg(F.collect_list("pos").alias("gone"))
    )


def dedup_lines(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with the lines removed from ``text``, and a struct ``__lines`` of ``total`` and ``removed``."""
    gone = removed_lines(docs, site, min_sites).select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.array_sort("gone").alias("__gone"))
    keep = F.filter(_lines(F.col("text")), lambda x, i: ~F.array_contains("__gone", i))
    removed = F.coalesce(F.size("__gone"), F.lit(0))
    total = F.coalesce(F.size(_lines(F.col("text"))), F.lit(0))
    keyed = docs.withColumn("__text_key", F.xxhash64("text"))
    return (
        keyed.join(gone, keyed["doc_id"].eqNullSafe(gone["__id"]) & (keyed["__text_key"] == gone["__key"]), "left")
        .withColumn("__lines", F.struct(
            F.when(F.col("text").isNull(), 0).otherwise(total).cast("long").alias("total"), removed.cast("long").alias("removed")))
        .withColumn("text", F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(keep, "\n")))
        .drop("__id", "__key", "__gone", "__text_key")
    )
