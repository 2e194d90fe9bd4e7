"""The corpus pipeline: five stages over `documents`, each written and read again.

1 quality rules drop documents, 2 SimHash, and an exact check after it, keep one document of each near-duplicate group,
3 decontamination drops documents that hold a benchmark passage, 4 secrets are masked in the
texts, 5 the remaining texts are BPE-encoded.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphvec.llm import bpe, decontam, quality, secrets, simhash
from graphvec.storage import new_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; a null, empty or very short text goes, repeated rows
    are judged alike, and a document without a doc_id is judged like any other."""
    return quality.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of near copies, which SimHash fingerprints or, after these,
    an exact check link; one row each; rows without a doc_id stay."""
    return simhash.keep_one_linked(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage; rows without a doc_id stay."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their secrets masked, and n_chars, if there is such a column, as it is
    afterwards; a null text stays null."""
    masked = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each document, with its columns but the text, and the digests of its tokens; a
    null or empty text has no tokens."""
    return bpe.digests(bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality_rules", quality_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("secret_scans", secrets_stage),
    ("bpe_encoding", encode_stage),
]

# XXH64 buckets and fingerprints, and BPE merges, are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
