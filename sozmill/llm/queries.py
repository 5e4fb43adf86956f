"""One query for each operator, over whole tables, as the contracts state them."""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    archives, bpe, cotraining, decontaminate, divergence, extraction, jaccard, language, licenses, merkle, negatives,
    packing, sharding,
)
from .common import ship, table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def op1_cotrained_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by its text and its metadata."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    model = cotraining.fit(docs, table(spark, sf_dir, "labels"))
    return cotraining.score(docs, model).select("doc_id", "text_score", "metadata_score", "score", "kept")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of the bytes decoded from them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN)


def op3_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict of the divergence rules for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = divergence.verdicts(docs, divergence.references(docs))
    return found.select(
        "doc_id", *divergence.BASE, "base_failed", "kept", "class_distance", "word_distance")


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group and number of links by five-word Jaccard similarity of 0.8 or more."""
    found = jaccard.join(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id", "n_links", "n_copies")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a window of a benchmark item."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; a third of them is held out from the fit."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1
    model = language.fit(docs.filter(~held_out))
    found = language.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op7_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard, of 16 that are as even in bytes as equal texts allow."""
    placed = sharding.shard(table(spark, sf_dir, "documents"), 16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op8_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as the WARC record that its ARC record became, read back."""
    return archives.archived(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extraction.extract(pages, extraction.fit(pages)).select("page_id", "url", "text", "n_chars")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base phrases and license detections of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    base = F.array_distinct(F.col("places.label"))
    return licenses.scan(docs).select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places.start").cast("long").alias("first_word"),
        F.array_max("places.start").cast("long").alias("last_word"),
        F.array_join(F.sort_array(base), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union(base, F.col("detections.label"))), ",").alias("labels"),
        licenses.strongest().alias("score"))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of at most 2,048 tokens."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, WORDS, 2048, 0, carry=lambda found: found.withColumn(
        "ids_crc32", F.crc32("ids")).drop("ids")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the positives of every fiftieth vector, against all vectors."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = negatives.mine(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, label=moved)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and what a tampered one folds to."""
    docs = table(spark, sf_dir, "documents")
    own = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    changed = F.when(hit, merkle.leaf(*own[:3], F.col("n_chars") + 1, own[4]))
    made = merkle.manifest(docs, "lang", "doc_id", merkle.leaf(*own), doc_id=F.col("doc_id"), tampered=changed)
    root = merkle.folded(F.coalesce("tampered", "leaf"), F.col("path"))
    return made.proofs().select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        root.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def shipped(query):
    """``query``, after the executors got this package."""
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)
    return run


def queries() -> dict:
    return {f.__name__: shipped(f) for f in (
        op1_cotrained_quality, op2_byte_bpe, op3_divergence_rules, op4_ngram_jaccard_join,
        op5_decontamination, op6_language_id, op7_minimax_shards,
        op8_arc_to_warc, op9_html_main_text, op10_license_scan, op11_best_fit_packing,
        op12_hard_negatives, op13_merkle_manifest)}
