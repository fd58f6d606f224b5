"""Corpus pipeline: stages from raw documents to token ids.

``STAGES`` lists (name, function); each function takes ``(spark, docs,
sf_dir)``, calls one operator on all documents its predecessor kept, and
returns a DataFrame. All but the last return the columns of ``docs``. ``run``
writes every stage's result to the shared folder and reads it back for the next.

Null texts pass the first stages like empty ones (the quality stage keeps both); the columns beside ``doc_id``,
``text`` and ``lang`` are carried along (``n_chars`` follows the text).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from consentflow.llm import byte_bpe, decontaminate, kneser_ney, line_dedup, simhash
from consentflow.llm.common import prepare, stage, table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity their language's quantile allows."""
    prepare(spark)
    return kneser_ney.filter_quality(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that repeat an earlier similar line."""
    prepare(spark)
    out = line_dedup.deduplicate(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    prepare(spark)
    return simhash.deduplicate(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    prepare(spark)
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document, and their digests."""
    prepare(spark)
    return byte_bpe.digest(byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_copies", near_copies),
    ("benchmark", benchmark),
    ("token_ids", token_ids),
]

# The language model, SimHash and BPE are beyond SQL: tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
