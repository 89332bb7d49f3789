"""Registered queries of the operators: thin uses of the operators with the agreed result columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spellcast.llm import (
    bpe, centroid_clusters, chat_format, decontaminate, html_extract, license_scan, minhash_dedup, quality_classifier,
    quality_rules, signature_join, substring_dedup, url_filter, vector_codes,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sha(text) -> F.Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", _sha(F.col("kept_text")).alias("kept_sha256"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("key")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"), url_filter.rule_table(spark))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(_table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_classifier.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), ["doc_id"])
    odds = {f: F.col(f"__odds_{f}") for f in quality_classifier.FAULTS}
    kept = ~(F.greatest(*odds.values()) > 0)
    return judged.select("doc_id", *((1 / (1 + F.exp(-o))).alias(f"p_{f}") for f, o in odds.items()), kept.alias("kept"))


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.components(_table(spark, sf_dir, "documents")).drop("key")


#: The conversation that the query adds, whose texts hold control strings.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.createDataFrame(
        [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)], "conv_id long, turn long, role string, text string"
    )
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    back = chat_format.read_back(chat_format.format_conversations(rows))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        _sha(turns).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        _sha(F.col("learned")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    coded = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"), decoded=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        _sha(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        _sha(F.col("decoded")).alias("decoded_sha256"),
    )


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signature_join.components(_table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.compress(_table(spark, sf_dir, "embeddings"))
    digits = F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0")))
    return coded.select(
        "vec_id", F.array_join(digits, "").alias("code"), "error", "label_error",
        F.lit(vector_codes.book_digest(books)).alias("codebooks_sha256"),
    )


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroid_clusters.cluster(_table(spark, sf_dir, "embeddings"))
    components = F.array_join(F.col("centroid").cast("array<string>"), ",")
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2(components, 256).alias("centroid_sha256"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_substring_dedup, op2_decontamination, op3_url_filter, op4_quality_rules, op5_quality_classifier, op6_minhash_dedup,
        op7_chat_format, op8_html_extraction, op9_bpe, op10_license_scan, op11_jaccard_join, op12_vector_codes, op13_centroid_clusters,
    )
}
