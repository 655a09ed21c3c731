"""The training-data pipeline: documents -> quality -> near-duplicates -> personal data -> mixing -> tokens.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept;
``run`` writes every stage's result as Parquet in the shared folder and reads
it back as the next one's input.  All stages but the last return the columns
of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.llm import bpe, mixing, order_minhash, pii, rules
from tidepanel.llm.common import apart, column, read_table, scratch_path, together


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble does not reject.

    It learns from the labelled documents outside the held-out fold.  With
    labels of one kind only, or none, there is nothing to tell documents
    apart by, and all stay.
    """
    model = rules.fit_quality(docs, read_table(spark, sf_dir, "labels", "doc_id", "quality"))
    if not model.rules:
        return docs
    plain, names = apart(docs, "text")
    scored = rules.score_quality(plain, model, score_col="score", class_col="good")
    return together(scored.filter("good = 1"), names, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, that of the smallest id."""
    return order_minhash.deduplicate(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind; n_chars follows."""
    clean = pii.redact(docs, pii.fit_tagger(docs))
    return clean.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else column(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at tempered weights, in permuted block order: the largest is read once, the smallest twice."""
    plain, names = apart(docs, "doc_id", "source", "text")
    order = ["mix_epoch", "mix_place"]
    mixed = mixing.mix_sources(plain, max_repeats=2.0).repartitionByRange(*order).sortWithinPartitions(*order)
    return together(mixed, names, docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents without the text (and any called like the results), and n_tokens and ids of the whole text."""
    keep = [c for c in docs.columns if c not in ("text", "n_tokens", "ids")]
    plain, names = apart(docs.select(*[column(c) for c in (*keep, "text")]), "doc_id", "text")
    ids = bpe.encode_documents(plain, public_tokenizers.path("byte_bpe_50k.json"), keep=tuple(names[:-1]))
    return ids.select(*[column(n).alias(c) for n, c in zip(names[:-1], keep, strict=True)], "n_tokens", "ids")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("personal_data", personal_data),
          ("mixing", mix), ("tokens", tokens)]

# Trained models, sketches and tokens: SQL cannot express the stages; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
