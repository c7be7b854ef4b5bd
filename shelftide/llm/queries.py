"""Registered queries of the pipeline operators and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, ctw, decontam, line_dedup, merkle, packing, quality, secrets, simhash, subwords, suffix_dedup, toxicity, trie


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_table(spark, sf_dir, "documents"))
    names = F.array(*[F.lit(k) for k in secrets.KINDS])
    count = lambda k: F.size(F.filter("secrets", lambda s: s["kind"] == k)).cast("long")
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(said(F.filter("secrets", lambda s: s["kind"] < 3)), 256).alias("base_sha256"), said(F.col("secrets")).alias("spans"),
        count(3).alias("n_format"),
    )


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contaminations(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "distance", "start", "end", "n_words")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], turns.schema)
    return chat.conversation_digests(chat.format_turns(turns.union(extra)))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = quality.quality_report(_table(spark, sf_dir, "documents"))
    return report.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = ctw.score_documents(_table(spark, sf_dir, "documents"))
    bits = -F.col("score") * F.log2(F.lit(10.0)) / F.col("n_bytes")
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", bits.alias("bits_per_byte"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))
    text = F.coalesce("text", F.lit(""))
    return out.select(
        "doc_id", F.col("__lines.total").alias("n_lines"), F.col("__lines.removed").alias("n_removed"),
        F.length(text).cast("long").alias("kept_chars"), F.sha2(text, 256).alias("kept_sha256"),
    )


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_components(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", F.col("junk").alias("p_junk"), F.col("toxic").alias("p_toxic"), (F.col("toxic") >= 0.5).alias("toxic"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify_documents(_table(spark, sf_dir, "documents")).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "n_levels")


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5, F.lit(-1))
    scored = subwords.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), rest != 0)
    return scored.select("doc_id", (rest == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = F.col("conv_id")
    return trie.prefix_trie(_table(spark, sf_dir, "conversations"), F.crc32(own.cast("string")) % 6, own - own % 100)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_chat_format": op5_chat_format,
    "op6_quality_rules": op6_quality_rules,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_line_dedup": op8_line_dedup,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_toxicity_chain": op10_toxicity_chain,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_quality_classifier": op12_quality_classifier,
    "op13_conversation_trie": op13_conversation_trie,
}
