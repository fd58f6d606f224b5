import pytest

import corpus_pipeline as P
import __spark_entry__ as entry
from consentflow.llm import queries as Q
from consentflow.llm import byte_bpe, kneser_ney, simhash
from consentflow.llm.common import stage, table
from tests.llm import test_byte_bpe, test_decontaminate, test_line_dedup, test_simhash
from tests.llm.helpers import edge_docs, empty_docs

SF = "/root/testdata/sf0.001"


def test_stages_by_brute_force(spark):
    """Each stage on its predecessor's rows, against a plain Python version."""
    docs = table(spark, SF, "documents")
    columns = docs.columns
    kept = P.quality(spark, docs, SF)
    assert kept.columns == columns
    scored = kneser_ney.score_quality(docs, table(spark, SF, "labels"))
    rows = {r.doc_id: r.text for r in kept.collect()}
    assert set(rows) == {r.doc_id for r in scored.where("perplexity <= threshold").collect()}
    good = {r.doc_id for r in table(spark, SF, "labels").where("quality = 1").collect()}
    long = {r.doc_id for r in docs.where("length(text) > 300").collect()}
    assert len(good & long & set(rows)) >= 0.95 * len(good & long)

    kept = kept.cache()
    lined = P.lines(spark, kept, SF).cache()
    assert lined.columns == columns and lined.where("n_chars <> length(text)").count() == 0
    texts = {r.doc_id: r.text for r in lined.collect()}
    assert texts == test_line_dedup.by_hand(list(rows.items()), 0.8)

    single = P.near_copies(spark, lined, SF).cache()
    assert single.columns == columns
    fps = [(i, test_simhash.fingerprint_by_hand(t)) for i, t in texts.items()]
    want = set(test_simhash.groups_by_hand(fps, 2).values())
    left = {r.doc_id: r.text for r in single.collect()}
    assert set(left) == want

    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    clean = P.benchmark(spark, single, SF)
    assert clean.columns == columns
    hit = {i for i, t in left.items() if test_decontaminate.by_hand(t, items)[-1]}
    assert {r.doc_id for r in clean.collect()} == set(left) - hit

    enc = byte_bpe._encoding(P.RANKS, test_byte_bpe.PATTERN)
    ids = P.token_ids(spark, clean, SF).collect()
    assert {r.doc_id: r.n_tokens for r in ids} == {i: len(enc.encode_ordinary(left[i])) for i in set(left) - hit}


@pytest.mark.parametrize("make", [edge_docs, empty_docs])
def test_stages_on_edges(spark, make):
    """Nulls, empty and very long texts, repeated rows and ids, clashing names,
    and the table without rows go through all stages."""
    docs = make(spark)
    columns, before = docs.columns, docs.count()
    for name, step in P.STAGES[:-1]:
        docs = stage(step(spark, docs, SF), f"edges-{name}")
        assert docs.columns == columns, name
        if name in ("quality", "lines"):
            assert docs.where("coalesce(text, '') = ''").count() >= (2 if before else 0)
    rows = P.token_ids(spark, docs, SF).collect()
    assert len(rows) == docs.count() <= before
    assert sum(r.n_tokens == 0 for r in rows) == (1 if before else 0)  # null, empty and blank texts are one group


def test_run_gives_the_last_stage(spark):
    rows = P.run(spark, SF).collect()
    assert rows and {"doc_id", "n_tokens"} <= set(rows[0].asDict())


def test_registered(spark):
    names = entry.queries()
    assert {n.split("_")[0] for n in Q.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(Q.QUERIES) <= set(names) and "pipeline" in names
    assert set(Q.ORACLE_SQL) <= set(entry.oracle_sql())
    assert len(P.STAGES) == 5 and simhash and P.ORACLE_SQL is None
