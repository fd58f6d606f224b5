"""Quality rules with a hashed n-gram log-likelihood ratio (operator 4, native).

Base rules count words, symbols, repeated lines and repeated 3-word windows.
The method's verdict compares two multinomials over hashed features (words and
pairs of neighbouring words in ``buckets`` buckets): trusted target text and
the raw corpus. A document's score is the sum over its features of
ln p_target - ln p_raw, divided by the number of features; it is kept at
``min_ratio`` or more. No sampling noise: the threshold decides every document.

Only DataFrame functions run: the features never leave the scan -- they are
counted by bucket with partial aggregation (at most ``buckets`` rows a task)
and looked up in an array of ``buckets`` weights, the one thing that passes the
driver. Raw counts cover all documents; the target is the labelled trusted
documents, at most ``max_docs`` of them (the documented bound; chosen by hash),
smoothed by ``smooth`` features of raw text.

Defined cases: null, empty and blank texts have no words and fail the base
rules; a text of one word has one feature; without trusted text all ratios are
0 and the base rules alone decide; repeated rows each give a row; repeated ids
share the trust of the id; a ratio equal to the threshold is kept; an empty table
gives an empty result; a text of any length is read whole; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from consentflow.llm.common import drop_empty

BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"


def words_of(text: Column) -> Column:
    return drop_empty(F.split(text, BLANKS))


def repeated_words(words: Column, window: int = 3) -> Column:
    """Number of words inside windows of ``window`` words that the text holds
    twice or more. Windows are sorted by a 64-bit hash, so equal ones meet:
    n log n for texts of any length."""
    n = F.size(words)
    grams = F.when(n >= window, F.transform(
        F.sequence(F.lit(0), n - window),
        lambda i: F.struct(F.xxhash64(*[F.get(words, i + k) for k in range(window)]).alias("h"), i.alias("i")))
    ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    return F.sort_array(grams)


def _count_repeated(ordered: Column, window: int = 3) -> Column:
    twice = F.filter(ordered, lambda x, k: (F.get(ordered, k - 1)["h"] == x["h"]) | (F.get(ordered, k + 1)["h"] == x["h"]))
    covered = F.flatten(F.transform(twice, lambda x: F.array(*[x["i"] + k for k in range(window)])))
    return F.size(F.array_distinct(covered)).cast("long")


def features(words: Column, buckets: int) -> Column:
    """Buckets of all words and of all pairs of neighbours."""
    n = F.size(words)
    one = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int"))
    two = F.when(n >= 2, F.transform(
        F.sequence(F.lit(0), n - 2),
        lambda i: F.pmod(F.xxhash64(F.get(words, i), F.get(words, i + 1)), F.lit(buckets)).cast("int"))
    ).otherwise(F.array().cast("array<int>"))
    return F.concat(one, two)


def trusted_ids(labels: DataFrame, id_col: str, label_col: str, max_docs: int) -> DataFrame:
    """At most ``max_docs`` ids that every label of theirs calls good."""
    return labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.min(F.coalesce(F.col(label_col), F.lit(0))).alias("low")).where("low = 1").select("id").orderBy(
        F.xxhash64("id"), "id").limit(max_docs)


def bucket_weights(docs: DataFrame, trusted: DataFrame, buckets: int, smooth: float) -> list[float]:
    """ln p_target - ln p_raw of every bucket (docs: ``id``, ``w``)."""
    # bounded: at most max_docs ids
    marked = docs.join(F.broadcast(trusted.select("id", F.lit(1).cast("long").alias("good"))), "id", "left")
    counted = marked.select("good", F.explode(features(F.col("w"), buckets)).alias("b")).groupBy("b").agg(
        F.count(F.lit(1)).alias("raw"), F.count("good").alias("target")).collect()
    raw_all, target_all = sum(r.raw for r in counted), sum(r.target for r in counted)
    weights = [0.0] * buckets
    if target_all:
        for r in counted:
            share = r.raw / raw_all
            # a bucket's target share leans on its raw share until enough target text is seen
            weights[r.b] = math.log((r.target + smooth * share) / (target_all + smooth)) - math.log(share)
    return weights


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                  buckets: int = 10_000, smooth: float = 10_000.0, min_ratio: float = -0.1, max_docs: int = 20_000) -> DataFrame:
    """One row per document: base counts, ``ratio`` and the verdict."""
    src = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("t"))
    worded = src.withColumn("w", words_of(F.col("t")))
    weights = bucket_weights(worded.select("id", "w"), trusted_ids(labels, id_col, label_col, max_docs), buckets, smooth)
    table = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")  # folded to one constant
    lines = F.filter(F.split(F.col("t"), "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    counted = worded.select(
        "id", F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        lines.alias("lines"), repeated_words(F.col("w")).alias("grams"), features(F.col("w"), buckets).alias("f"))
    total = F.aggregate("f", F.lit(0.0), lambda acc, b: acc + F.get(table, b))
    scored = counted.select(
        "id", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _count_repeated(F.col("grams")).alias("n_repeat_words"),
        F.when(F.size("f") > 0, total / F.size("f")).otherwise(0.0).alias("ratio"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return scored.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         failed.alias("base_failed"), (~failed & (F.col("ratio") >= min_ratio)).alias("kept"), "ratio")
