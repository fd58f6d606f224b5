"""Small fixtures shared by the operator tests."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType())])


def docs_of(spark, rows, schema=DOCS):
    return spark.createDataFrame([tuple(r) if len(r) == 3 else (*r, "en") for r in rows], schema)


def words(rng, n, vocab=40):
    return " ".join(f"w{rng.randrange(vocab)}" for _ in range(n))


def edge_docs(spark, extra=()):
    """Nulls in every column, empty, blank and long texts, repeated rows and
    ids, non-ASCII, and extra columns whose names the operators use inside."""
    rng = random.Random(3)
    rows = [(1, None, "en"), (2, "", "en"), (3, " \t\n ", None), (None, "Only One null id", "de"),
            (4, "repeat me please", "en"), (4, "repeat me please", "en"), (4, "another text", "en"),
            (5, words(rng, 30_000, 5000), "en"), (6, "ÀÉ ß Straße 日本語 😀 don't", "fr"), (7, "x" * 20_000, "en"),
            (8, "a\n\na\nb a\n a \n", "es"), *[(i, t, "en") for i, t in extra]]
    base = docs_of(spark, rows)
    clash = ["id", "t", "k", "w", "n", "p", "kept", "spans", "row", "tail", "no", "item", "shard", "c0", "ids", "perplexity", "n_words"]
    return base.selectExpr("*", *[f"'clash' AS `{c}`" for c in clash])


def null_docs(spark):
    """Every column null."""
    return docs_of(spark, [(None, None, None), (None, None, None)])


def empty_docs(spark):
    return docs_of(spark, [])
