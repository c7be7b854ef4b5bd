"""Quality rules with thresholds that each language and source sets itself.

Per document: counts of words, symbols, repeated lines, repeated word windows and capitals, as whole numbers.
Per (language, source): a quantile sketch of each signal. A sketch is a histogram whose buckets keep the leading
``SKETCH_BITS`` bits of a value, so a quantile is off by 1/32 of its value at most, sketches merge by adding counts, and
the same rows give the same sketch however they are dealt out. Sketches of a language and of all rows are merged from
those of the sources and stand in for groups with fewer than ``MIN_GROUP`` documents. A signal fails above
``q75 + FENCE * (q75 - q25) + slack``. Everything is built from DataFrame functions.

Null text counts as no words and fails the base rules; null language or source is a group like any other. Repeated rows
are judged alike. An empty table gives an empty result, and columns named like signals live in a struct of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import SPACE, let, stored, words_of

SKETCH_BITS = 6
MIN_GROUP = 200
FENCE = 3
WINDOW = 5

#: Signal: its least distance from the upper quartile to the threshold. Fixed values, per mille of words or characters.
SLACK = {"symbols": 40, "dup_lines": 600, "repeats": 190, "capitals": 150}

_Q = "__quality"


def _repeat_words(words: Column) -> Column:
    """Words inside windows of five words that occur twice or more in the text."""
    n = F.size(words)
    hashes = F.when(
        n >= WINDOW,
        F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])),
    ).otherwise(F.array().cast("array<bigint>"))

    def covered(starts: Column) -> Column:
        first = F.struct(F.lit(-WINDOW).alias("prev"), F.lit(0).alias("total"))
        return F.aggregate(
            starts, first,
            lambda a, x: F.struct(x.alias("prev"), (a["total"] + F.least(F.lit(WINDOW), x - a["prev"])).alias("total")),
            lambda a: a["total"],
        )

    def among(pairs: Column) -> Column:
        def again(k: Column) -> Column:
            h = F.get(pairs, k)["h"]
            return F.coalesce(h == F.get(pairs, k - 1)["h"], F.lit(False)) | F.coalesce(h == F.get(pairs, k + 1)["h"], F.lit(False))

        found = F.filter(F.sequence(F.lit(0), F.size(pairs) - 1), again)
        return covered(F.sort_array(F.transform(found, lambda k: F.get(pairs, k)["i"])))

    def count(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), let(pairs, among)).otherwise(F.lit(0))

    return let(hashes, count)


def signals(text: Column) -> Column:
    """A struct of the counts of one text."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(f"[^{SPACE[1:-1]}]"))
    return let(words_of(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
        (F.length(whole) - F.length(F.regexp_replace(whole, "[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
        _repeat_words(w).cast("long").alias("n_repeat_words"),
        F.size(F.split(whole, "\n")).cast("long").alias("n_lines"),
        (F.length(whole) - F.length(F.regexp_replace(whole, "[A-Z]+", ""))).cast("long").alias("n_capitals"),
    ))


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the struct ``__quality``."""
    return docs.withColumn(_Q, signals(F.col("text")))


def _rates(q: str = _Q) -> dict[str, Column]:
    c = lambda name: F.col(f"{q}.{name}")
    per = lambda a, b: F.floor(1000 * a / F.greatest(b, F.lit(1).cast("long"))).cast("long")
    return {
        "symbols": per(c("n_symbols"), c("n_words")), "dup_lines": per(c("n_dup_lines"), c("n_lines")),
        "repeats": per(c("n_repeat_words"), c("n_words")), "capitals": per(c("n_capitals"), c("word_chars")),
    }


def _bucket(v: Column) -> Column:
    drop = F.greatest(F.length(F.bin(v)) - SKETCH_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, drop), drop)


def sketches(rows: DataFrame) -> DataFrame:
    """Counts per language, source, signal and bucket; ``level`` 0 is a source, 1 a language, 2 all rows."""
    pairs = F.array(*[F.struct(F.lit(k).alias("signal"), _bucket(v).alias("bucket")) for k, v in _rates().items()])
    fine = (
        rows.select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), F.inline(pairs))
        .groupBy("g_lang", "g_source", "signal", "bucket").agg(F.count(F.lit(1)).alias("n"))
    )
    levels = F.explode(F.array(
        F.struct(F.lit(0).alias("level"), F.col("g_lang").alias("lang"), F.col("g_source").alias("source")),
        F.struct(F.lit(1).alias("level"), F.col("g_lang").alias("lang"), F.lit(None).cast("string").alias("source")),
        F.struct(F.lit(2).alias("level"), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source")),
    ))
    return (
        fine.select("signal", "bucket", "n", levels.alias("l")).select("l.*", "signal", "bucket", "n")
        .groupBy("level", "lang", "source", "signal", "bucket").agg(F.sum("n").alias("n"))
    )


def thresholds(sketch: DataFrame) -> DataFrame:
    """Limits of each language and source, taken from the finest level with enough documents."""
    group = ["level", "lang", "source", "signal"]
    up_to = F.sum("n").over(Window.partitionBy(*group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("n").over(Window.partitionBy(*group))
    ranked = sketch.withColumns({"up_to": up_to, "total": total})
    at = lambda q: F.min(F.when(F.col("up_to") * 100 >= F.col("total") * q, F.col("bucket")))
    slack = F.coalesce(*[F.when(F.col("signal") == k, F.lit(v)) for k, v in SLACK.items()])
    limit = (F.col("q75") + FENCE * (F.col("q75") - F.col("q25")) + slack).alias("limit")
    limits = (
        ranked.groupBy(*group).agg(at(25).alias("q25"), at(75).alias("q75"), F.max("total").alias("total"))
        .select(*group, "total", limit)
        .groupBy("level", "lang", "source").pivot("signal", list(SLACK)).agg(F.first("limit"))
    )
    sizes = sketch.filter(F.col("signal") == next(iter(SLACK))).groupBy("level", "lang", "source").agg(F.sum("n").alias("docs"))
    keys = ["level", "lang", "source"]
    limits = (
        limits.alias("x").join(sizes.alias("y"), [F.col(f"x.{k}").eqNullSafe(F.col(f"y.{k}")) for k in keys])
        .select("x.*", F.struct("y.docs", *[f"x.{k}" for k in SLACK]).alias("own"))
    )
    whole = limits.filter(F.col("level") == 2).select("own").first()
    of_all = F.struct(*[F.lit(whole[0][k] if whole else None).cast("long").alias(k) for k in ("docs", *SLACK)])
    a = limits.filter(F.col("level") == 0).select("lang", "source", "own")
    b = limits.filter(F.col("level") == 1).select("lang", F.col("own").alias("of_lang"))
    joined = a.join(b, a["lang"].eqNullSafe(b["lang"])).select(a["lang"], a["source"], "own", "of_lang")
    use = F.when(F.col("own.docs") >= MIN_GROUP, F.col("own")).when(F.col("of_lang.docs") >= MIN_GROUP, F.col("of_lang")).otherwise(of_all)
    return joined.select(F.col("lang").alias("__lang"), F.col("source").alias("__source"), use.alias("__limits"))


def judged(rows: DataFrame) -> DataFrame:
    """Rows of :func:`measured` with ``base_failed`` and ``kept`` added to their struct.

    ``rows`` is read twice, so pass a stored table.
    """
    limits = stored(thresholds(stored(sketches(rows))))
    base = (F.col(f"{_Q}.n_words") < 10) | (100 * F.col(f"{_Q}.n_repeat_words") > 20 * F.col(f"{_Q}.n_words"))
    over = F.lit(False)
    for k, v in _rates().items():
        over = over | (v > F.col(f"__limits.{k}"))
    return (
        rows.join(limits, rows["lang"].eqNullSafe(limits["__lang"]) & rows["source"].eqNullSafe(limits["__source"]), "left")
        .withColumn(_Q, F.col(_Q).withField("base_failed", base).withField("kept", ~base & ~F.coalesce(over, F.lit(False))))
        .drop("__lang", "__source", "__limits")
    )


def quality_report(docs: DataFrame) -> DataFrame:
    """One row per document: its counts, ``base_failed`` and ``kept``."""
    rows = stored(measured(docs).select("doc_id", "lang", "source", _Q))
    return judged(rows).select("doc_id", f"{_Q}.*")


def quality_filter(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, columns unchanged."""
    return judged(stored(measured(docs))).filter(F.col(f"{_Q}.kept")).select(*docs.columns)
