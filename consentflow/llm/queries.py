"""Registered queries of the training-data operators, one per operator.

Each applies its operator with production parameters to its whole table and
returns the contract's digest of the operator's result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from consentflow.llm import (best_fit, byte_bpe, decontaminate, fill_in_middle, kneser_ney, line_dedup, log_bilinear,
                             quality_rules, secret_scan, simhash, token_output, tokenizer_alignment, trie_counts)
from consentflow.llm.common import prepare, table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: base patterns and guess-cost spans."""
    return secret_scan.digest(secret_scan.scan_secrets(table(spark, sf_dir, "documents")))


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids written with Elias-Fano boundaries and read back."""
    return token_output.token_output(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram token counts of every document by a shared trie."""
    return trie_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the hashed n-gram verdict of every document."""
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier similar line, and the text left, by document."""
    return line_dedup.digest(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark phrases (and near meetings of their rarest terms) in every document."""
    return decontaminate.digest(decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op7_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document and whether its language's quantile keeps it."""
    return kneser_ney.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "lang", "n_symbols", "perplexity", "threshold", "kept")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document."""
    return simhash.digest(simhash.near_duplicates(table(spark, sf_dir, "documents")))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document, decoded again."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return byte_bpe.digest(encoded, ranks, public_tokenizers.PATTERN)


def op10_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and log-bilinear log10 probabilities of every document."""
    return log_bilinear.score(table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-the-middle form of every document, and the text rebuilt from it."""
    return fill_in_middle.digest(fill_in_middle.transform(table(spark, sf_dir, "documents")))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of two tokenizers' ids that cover the same bytes, and their links."""
    return tokenizer_alignment.digest(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"))


def op13_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1,024 tokens."""
    return best_fit.digest(best_fit.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


def _prepared(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)
    run.__doc__ = fn.__doc__
    return run


QUERIES = {f.__name__: _prepared(f) for f in (
    op1_secret_scan, op2_token_output, op3_token_counts, op4_quality_rules, op5_line_dedup, op6_decontaminate,
    op7_kneser_ney, op8_simhash, op9_byte_bpe, op10_log_bilinear, op11_fill_in_middle, op12_tokenizer_alignment,
    op13_best_fit)}

# The others hash, tokenise or train beyond what SQL offers: tests compare them by brute force.
ORACLE_SQL: dict[str, str] = {"op5_line_dedup": line_dedup.ORACLE_SQL, "op6_decontaminate": decontaminate.ORACLE_SQL}
