"""A corpus pipeline: documents through five operators, each stage written and read again.

Stages take (spark, docs, sf_dir) and return the columns of documents, the last one its digests. Each
stage judges what its predecessor kept. Rows without a doc_id pass the filters by the rules that the
operators state.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spellcast.llm import bpe, decontaminate, minhash_dedup, quality_classifier, substring_dedup
from spellcast.session import shared_folder
from spellcast.sources.io import delete_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are more likely toxic or of low quality than not."""
    return quality_classifier.good(docs.select(COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of every component of near-duplicates."""
    return minhash_dedup.keep_one(docs.select(COLUMNS))


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes word passages that an earlier document has; a document that loses all its words goes."""
    out = substring_dedup.remove_repeats(docs, carry=("lang", "source", "n_chars"))
    changed = F.col("n_removed") > 0
    text = F.when(changed, F.col("kept_text")).otherwise(F.col("text"))
    return out.filter("n_removed = 0 or n_removed < n_words").select(
        "doc_id", text.alias("text"), "carried.lang", "carried.source",
        F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("carried.n_chars")).alias("n_chars"),
    )


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a test item."""
    return decontaminate.clean(docs.select(COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, with whether decoding gives the text back."""
    coded = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"), decoded=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", classify),
    ("minhash_dedup", drop_near_copies),
    ("substring_dedup", drop_repeats),
    ("decontamination", drop_leaks),
    ("bpe", tokenize),
]

#: The classifier is a fitted model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; results between stages lie in the session's shared folder.

    A stage's copy is deleted when the next one is complete; the last one is what the result reads.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    place = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{place}/{name}")
        docs = spark.read.parquet(f"{place}/{name}")
        if before is not None:
            delete_path(spark, before)
        before = f"{place}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
