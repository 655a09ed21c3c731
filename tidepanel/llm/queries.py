"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, ctw, debruijn, merkle, mixing, order_minhash, pair_search, pii, repeats, rules, spotsigs, topk, warc
from .common import bucket_of, read_table, scratch_path

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[f.__name__] = f
    return f


@query
def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every text and the text decoded from them, as digests."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record, then the archives read back in byte ranges."""
    path = scratch_path(spark, "warc")
    warc.write_archive(read_table(spark, sf_dir, "pages", "page_id", "url", "html"), path)
    return warc.archive_report(spark, path)


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents mixed by source: the largest source once, the smallest at most twice."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "source", "text")
    counted = docs.select("doc_id", "source", mixing.word_count("text").alias("n_tokens"))
    mixed = mixing.mix_sources(counted, tokens=F.col("n_tokens"), max_repeats=2.0)
    return mixed.select("doc_id", "source", "n_tokens", F.col("mix_weight").alias("weight"),
                        F.col("mix_epoch").alias("epoch"), F.col("mix_place").alias("place"))


@query
def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 largest integer inner products of every 50th vector with all others."""
    vectors = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return topk.top_inner_products(vectors, F.col("v") % 50 == 0, k=5)


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every text by rules learnt from the labelled rows outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    model = rules.fit_quality(docs, read_table(spark, sf_dir, "labels", "doc_id", "quality"))
    return rules.score_quality(docs, model).select(
        "doc_id", F.coalesce(bucket_of("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", "predicted")


@query
def op4_context_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text scored by context-tree weighting over the training fold, beside the add-one word model."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return ctw.score_texts(docs, ctw.fold_held_out("doc_id"))


@query
def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near-duplicates of every document (similarity of five-word shingles 0.8 or more)."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    classes = order_minhash.near_duplicate_classes(docs)
    return classes.select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))


@query
def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every text that no 400-byte string seen elsewhere covers."""
    return repeats.remove_repeats(read_table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op8_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every text and of its edited text, and how alike both and the next document's are."""
    pairs = spotsigs.edited_pairs(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    p = pairs.withColumn("edited_sig", spotsigs.signature(F.col("edited")))
    return p.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                    spotsigs.as_string(F.col("sig")).alias("fingerprint"), spotsigs.as_string(F.col("edited_sig")).alias("edited_fingerprint"),
                    spotsigs.likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"),
                    spotsigs.likeness(F.col("sig"), F.col("next_sig")).alias("near_next"))


@query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every text: pattern spans, and those the trained tagger adds."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return pii.find_personal_data(docs, pii.fit_tagger(docs))


@query
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle proof of every document by language, checked against a copy with every third text lower-cased."""
    return merkle.tamper_report(read_table(spark, sf_dir, "documents", *merkle.COLUMNS))


@query
def op12_debruijn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every text that no 13-word window of an earlier document covers."""
    return debruijn.remove_earlier(read_table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op13_pair_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for every benchmark item."""
    return pair_search.search(read_table(spark, sf_dir, "documents", "doc_id", "text"), read_table(spark, sf_dir, "benchmark", "item_id", "text"))
