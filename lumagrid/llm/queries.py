"""Queries over the given tables, one for each operator, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumagrid.llm import bpe, codes, conversations, decontamination, html, language, minhash, pii, piece_counts, quality, suffix, topk, warc
from lumagrid.llm.common import read
from lumagrid.llm.oracles import LLM_ORACLES

__all__ = ["LLM_ORACLES", "LLM_QUERIES"]


def source_parts() -> dict:
    """Host and path of a document: its source, and the path in it or else the section of its language."""
    source = F.col("source")
    return {"host": quality.host_of(source), "path": F.coalesce(F.nullif(quality.path_of(source), F.lit("")), F.col("lang"))}


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Evidence, site posterior, posterior and decision for every document."""
    docs = read(spark, folder, "documents")
    scored = quality.score(docs, read(spark, folder, "labels"), **source_parts())
    return scored.select("doc_id", "quality.*")


def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the token ids of every document, and of the bytes that the ids decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(read(spark, folder, "documents"), path, public_tokenizers.PATTERN)
    decoded = bpe.fingerprint(bpe.decode(encoded, path))
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Metadata and conversion records of every page, held in a response record."""
    pages = read(spark, folder, "pages")
    date = F.lit("2024-01-01T00:00:00Z")
    records = warc.responses(pages, F.col("page_id"), F.col("url"), F.col("html"), date)
    derived = warc.derivatives(records, "key").withColumnRenamed("key", "page_id")
    return derived.withColumn("record_sha256", F.sha2("record", 256)).drop("record")


def op4_html(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    pages = read(spark, folder, "pages").select("page_id", "url", "html")
    found = html.extract(pages, html.train(pages, "html", F.xxhash64("page_id", "url")))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Hit words and occurring benchmark items of every document."""
    docs = read(spark, folder, "documents").select("doc_id", "text")
    found = decontamination.find(docs, read(spark, folder, "benchmark"), into="found")
    n_hit = F.aggregate("found.spans", F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])
    return found.select(
        "doc_id",
        "found.n_words",
        n_hit.alias("n_hit"),
        F.size("found.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op6_suffix(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes left of every document once repeated strings of 100 bytes are gone."""
    kept = suffix.remove(read(spark, folder, "documents").select("doc_id", "text"), size=100)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


#: Stands in for the secret that a real job is given; surrogates change with it.
PII_KEY = b"given to the job by its owner"


def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with surrogates in place of personal data."""
    docs = read(spark, folder, "documents").select("doc_id", "text")
    clean = pii.replace(docs, PII_KEY, counted="n_entities")
    return clean.withColumn("text_sha256", F.sha2("text", 256))


def op8_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The five best rows by whole-number inner product for every vector whose id is divisible by 50."""
    vectors = read(spark, folder, "embeddings").select("vec_id", "embedding")
    return topk.search(vectors.filter(F.col("vec_id") % 50 == 0), vectors, k=5)


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from two thirds of them."""
    docs = read(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    pieces = language.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    labelled = docs.filter(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    model = language.train(labelled, pieces, "text", "lang", F.xxhash64("doc_id"))
    told = language.predict(docs.select("doc_id", "text"), model, into="told")
    return told.select(
        "doc_id", held_out.alias("held_out"), F.col("told.lang").alias("lang_pred"), F.col("told.score").alias("score")
    )


def op10_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate component of every document, linked from a similarity of 0.85."""
    docs = read(spark, folder, "documents").select("doc_id", "text")
    found = minhash.near_duplicates(docs, threshold=85)
    return found.select(F.col("key").alias("doc_id"), "n_shingles", "component_id", "kept")


def op11_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """Faults of damaged conversations, the cheapest edits that repair them, and a digest of the result."""
    given = read(spark, folder, "conversations")
    found = conversations.repair(conversations.damage(given)).digests()
    every = given.select("conv_id").distinct()
    joined = every.join(found, every["conv_id"].eqNullSafe(found["key"]), "left").drop("key")
    nothing = {c: F.coalesce(c, F.lit(0).cast("bigint")) for c in conversations.COUNTS}
    nothing["audit"] = F.coalesce("audit", F.lit(""))
    nothing["repaired_sha256"] = F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256))
    return joined.withColumns(nothing)


def op12_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Codes of all vectors: 8 parts, 16 entries, 6 rounds."""
    found, book = codes.compress(read(spark, folder, "embeddings"), parts=8, entries=16, rounds=6, scale=4096)
    return found.select("vec_id", "code", "error", "label_error", F.lit(codes.digest(book)).alias("codebooks_sha256"))


def op13_piece_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it exceeds the window of 4,096 tokens."""
    pieces = piece_counts.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    return piece_counts.count(read(spark, folder, "documents"), pieces, limit=4096)


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_bpe": op2_bpe,
    "op3_warc": op3_warc,
    "op4_html": op4_html,
    "op5_decontamination": op5_decontamination,
    "op6_suffix": op6_suffix,
    "op7_pii": op7_pii,
    "op8_topk": op8_topk,
    "op9_language": op9_language,
    "op10_minhash": op10_minhash,
    "op11_conversations": op11_conversations,
    "op12_codes": op12_codes,
    "op13_piece_counts": op13_piece_counts,
}
