"""A training-data pipeline over the documents table: each stage is one operator, its result a table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumagrid.llm import bpe, decontamination, minhash, pii, quality
from lumagrid.llm.common import materialise, read
from lumagrid.llm.queries import PII_KEY, source_parts


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep(docs, read(spark, sf_dir, "labels"), **source_parts())


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more."""
    return minhash.dedup(docs, threshold=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data and their new lengths."""
    clean = pii.replace(docs, PII_KEY)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digest of the bytes that they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(docs, path, public_tokenizers.PATTERN)
    decoded = bpe.decode(encoded, path)
    n_tokens = F.size("ids").cast("bigint").alias("n_tokens")
    return decoded.select("doc_id", n_tokens, "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", classify_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("PII", replace_personal_data),
    ("byte-level BPE", tokenise),
]

#: A trained model, keyed surrogates and tokenisation are beyond SQL; tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
