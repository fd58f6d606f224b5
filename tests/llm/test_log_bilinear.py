import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from consentflow.llm import log_bilinear as M
from consentflow.llm.common import prepare
from tests.llm.helpers import docs_of, edge_docs, empty_docs, null_docs


def out_by_hand(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def base_by_hand(rows):
    counts = Counter()
    for i, t in rows:
        if not out_by_hand(i):
            counts.update(M.words_of(t))
            counts["end"] += 1
    n, v = sum(counts.values()), len(counts)
    lp = lambda c: math.log10((c + 0.5) / (n + 0.5 * (v + 1)))
    out = []
    for i, t in rows:
        cs = [counts.get(w, 0) for w in M.words_of(t)] + [counts["end"]]
        out.append((i, out_by_hand(i), len(cs), sum(c > 0 for c in cs), n, sum(map(lp, cs))))
    return out


def sentences(rng, n):
    """Two kinds of texts whose next word depends on the word before."""
    chain = {k: [rng.randrange(60) for _ in range(4)] for k in range(60)}
    rows = []
    for i in range(n):
        w, ws = rng.randrange(60), []
        for _ in range(rng.randint(5, 60)):
            ws.append(f"T{w}" if w % 7 else f"rare{rng.randrange(5000)}")
            w = rng.choice(chain[w])
        rows.append((i, " ".join(ws)))
    return rows


def test_base_score_agrees_with_counting(spark):
    prepare(spark)
    rows = sentences(random.Random(18), 150)
    for head in (20, 100_000):
        got = M.score(docs_of(spark, rows), vocab=30, head=head).collect()
        by = {r.doc_id: r for r in got}
        for i, out, n, known, train, base in base_by_hand(rows):
            r = by[i]
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out, n, known, train)
            assert r.base_score == pytest.approx(base, rel=1e-9)


def test_model_beats_the_unigram_on_texts_it_has_not_seen(spark):
    prepare(spark)
    rows = M.score(docs_of(spark, sentences(random.Random(19), 400)), vocab=60).where("held_out").collect()
    assert len(rows) > 40
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows) + 50


def test_tail_join_does_not_change_scores(spark):
    prepare(spark)
    docs = docs_of(spark, sentences(random.Random(20), 80))
    a = {r.doc_id: r.score for r in M.score(docs, vocab=20, head=25).collect()}
    b = {r.doc_id: r.score for r in M.score(docs, vocab=20, head=100_000).collect()}
    assert a == pytest.approx(b, rel=1e-6)


def test_probabilities_are_normalised():
    rng = np.random.default_rng(0)
    pairs = rng.integers(0, 50, (14, 14)).astype(float)
    params, steps = M.fit(pairs, rng.integers(0, 9, (14, 14)).astype(float))
    assert 0 <= steps <= 160
    assert np.allclose((10 ** M.log10_table(params, rows=5)).sum(1), 1.0)
    head = [(f"w{i}", 40 - i) for i in range(20)]
    m = M.Model(head, 12, params, n_train=900, n_types=60, end_count=30).open()
    # known types beyond the model's vocabulary and the unknown one share the class "rest"
    rest_types = [(40 - i) for i in range(12, 20)]
    others = 900 - sum(n for _, n in head) - 30
    n_other = 60 - 20 - 1
    mass = sum(10 ** (math.log10((c + 0.5) / m.norm) - m.rest) for c in rest_types) + (
        others + 0.5 * n_other) / m.norm / 10 ** m.rest + 0.5 / m.norm / 10 ** m.rest
    assert mass == pytest.approx(1.0)


def test_contrast_finds_the_conditional_distribution():
    """With all pairs seen often, the model comes close to the counts."""
    rng = np.random.default_rng(1)
    true = rng.dirichlet(np.ones(8), 8)
    params, _ = M.fit(true * 10_000, dims=8, steps=1500)
    assert np.abs(10 ** M.log10_table(params) - true).max() < 0.05


def test_edges(spark):
    prepare(spark)
    df = edge_docs(spark)
    rows = M.score(df, vocab=20).collect()
    assert len(rows) == df.count()
    want = base_by_hand([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known) for r in rows) == sorted((str(i), n, k) for i, _, n, k, *_ in want)
    assert all(math.isfinite(r.score) for r in rows)
    assert M.score(null_docs(spark)).count() == 2
    assert M.score(empty_docs(spark)).count() == 0
    held = docs_of(spark, [(i, "no training text") for i in range(50) if out_by_hand(i)])
    assert all(r.n_known == 0 and r.train_tokens == 0 and r.base_score == 0.0 and math.isfinite(r.score) for r in M.score(held).collect())


def trained(spark, rows, **options):
    train = docs_of(spark, rows).selectExpr("text AS t", "doc_id % 5 = 0 AS dev")
    return M.train_model(train, options.pop("vocab", None), options.pop("growth", 12.0), options.pop("head", 100_000), **options)


def test_pairs_by_hand(spark):
    prepare(spark)
    rows = [(i, t) for i, (_, t) in enumerate(sentences(random.Random(22), 60))] + [(60, ""), (61, None)]
    ids = {b"t1": 0, b"t2": 1, b"t3": 2}
    of = lambda w: ids.get(w, 3 + M.class_of(w, 4))
    want = Counter()
    for i, t in rows:
        path = [7, *map(of, M.words_of(t)), 7]
        want.update(((i % 5 == 0) * 8 + a) * 8 + b for a, b in zip(path, path[1:]))
    got = M.pair_counts(docs_of(spark, rows).selectExpr("text AS t", "doc_id % 5 = 0 AS dev"), ids, 3, 4).collect()
    assert {r.pair: r.n for r in got} == want


def test_every_class_is_normalised(spark):
    """Training words, one unknown word of each class and the end sum to one
    after every context."""
    prepare(spark)
    rows = sentences(random.Random(23), 120)
    m, _ = trained(spark, rows, vocab=15, steps=20)
    counts = Counter(w for _, t in rows for w in M.words_of(t))
    assert m.classes > 1 and m.n_types == len(counts) + 1
    table = 10 ** M.log10_table(m.params)
    m.open()
    total = table[:, m.size + m.classes] + table[:, :m.size].sum(1)
    for w, n in counts.items():
        if m.ids[w] >= m.size:
            c = M.class_of(w, m.classes)
            total += table[:, m.size + c] * (n + 0.5) / m.norm / 10 ** m.rest[c]
    for c in range(m.classes):
        total += table[:, m.size + c] * 0.5 / m.norm / 10 ** m.rest[c]
    assert np.allclose(total, 1.0)


def test_scores_by_hand(spark):
    """Every document's score from the table of probabilities, word by word."""
    prepare(spark)
    rows = sentences(random.Random(24), 90) + [(500, ""), (501, None), (502, "Ünknown T1 never-seen")]
    options = {"vocab": 18, "steps": 30}
    train = [(i, t) for i, t in rows if not out_by_hand(i)]
    learn = docs_of(spark, train).select(M.F.col("text").alias("t"), (M.F.pmod(M.text_key(M.F.col("text")), M.F.lit(5)) == 0).alias("dev"))
    m, _ = M.train_model(learn, 18, 12.0, 100_000, steps=30)
    table = M.log10_table(m.params)
    counts = Counter(w for _, t in train for w in M.words_of(t))
    m.open()
    got = {r.doc_id: r.score for r in M.score(docs_of(spark, rows), head=25, **options).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        at, want = m.size + m.classes, 0.0
        for w in M.words_of(t):
            k = m.ids.get(w, m.size)
            c = M.class_of(w, m.classes)
            to = k if k < m.size else m.size + c
            want += table[at, to] + (0 if k < m.size else math.log10((counts[w] + 0.5) / m.norm) - m.rest[c])
            at = to
        assert got[i] == pytest.approx(want + table[at, m.size + m.classes], rel=1e-9)


def test_the_model_grows_with_the_vocabulary(spark):
    prepare(spark)
    def sizes(n):
        m, _ = trained(spark, [(i, f"w{i} common x{i} y{i}") for i in range(n)], steps=0)
        return m.size, m.classes
    (a, b), (c, d) = sizes(30), sizes(800)
    assert c > 2 * a and d > 2 * b


def test_blocks_of_contexts_learn_as_well_as_all_at_once():
    rng = np.random.default_rng(3)
    true = rng.dirichlet(np.ones(8), 8)
    cells = np.arange(64)
    params, _ = M.fit(M.Pairs(8, cells, (true * 10_000).ravel(), block=3), dims=8, steps=4500)
    assert np.abs(10 ** M.log10_table(params) - true).max() < 0.07
