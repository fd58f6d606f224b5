import hashlib
import random
import re

from consentflow.llm import decontaminate as D
from consentflow.llm.common import prepare
from tests.llm.helpers import docs_of, edge_docs, empty_docs, null_docs

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def words_by_hand(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER)) if w]


def by_hand(text, items, window=10):
    w = words_by_hand(text)
    hit, found = set(), set()
    for item_id, item in items:
        v = words_by_hand(item)
        n = min(len(v), window)
        for s in range(len(v) - n + 1 if v else 0):
            for p in range(len(w) - n + 1):
                if w[p:p + n] == v[s:s + n]:
                    hit.update(range(p, p + n))
                    if item_id is not None:
                        found.add(str(item_id))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def corpus(rng):
    vocab = [f"w{i}" for i in range(12)] + ["Émile", "été", "z9"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(1, 25)))) for i in range(12)]
    items += [(20, items[3][1]), (3, items[4][1]), (None, " ".join(f"nul{i}" for i in range(12))), (30, None), (31, " ,. "), (32, "only")]
    docs = []
    for i in range(120):
        parts = []
        for _ in range(rng.randint(0, 6)):
            own = rng.choice(items)[1] or ""
            cut = words_by_hand(own)
            a = rng.randint(0, max(len(cut) - 1, 0))
            parts.append(rng.choice([own, own.upper(), ", ".join(cut[a:a + rng.randint(1, 14)]), " ".join(rng.choice(vocab) for _ in range(8)), "--\n"]))
        docs.append((i, " ".join(parts)))
    return docs, items


def test_agrees_with_comparing_all_windows(spark):
    prepare(spark)
    for seed, window in ((1, 10), (2, 4)):
        docs, items = corpus(random.Random(seed))
        found = D.contamination(docs_of(spark, docs), items_of(spark, items), window=window)
        got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in D.digest(found).collect()}
        assert got == {i: by_hand(t, items, window) for i, t in docs}
        assert 0 < sum(x[-1] for x in got.values()) < len(got)


def test_proximity(spark):
    prepare(spark)
    item = "the of rare1 and to in is rare2 on at"
    docs = [(1, "rare2 of the rare1 and"), (2, "rare1 " + "x " * 30 + "rare2"), (3, item), (4, "the of and to in is on at " * 5), (5, "rare1 rare1")]
    got = {r.doc_id: (r.n_hit, r.n_near) for r in D.digest(D.contamination(
        docs_of(spark, docs), items_of(spark, [(1, item)]), near=10)).collect()}
    assert got == {1: (0, 1), 2: (0, 0), 3: (10, 1), 4: (0, 0), 5: (0, 0)}


def test_edges(spark):
    prepare(spark)
    df = edge_docs(spark, [(9, "Say: repeat ME, please! ok")])
    items = items_of(spark, [(7, "repeat me please"), (8, "x" * 20_000)])
    rows = D.digest(D.contamination(df, items)).collect()
    assert len(rows) == df.count()
    assert sorted(r.n_hit for r in rows if r.doc_id == 4) == [0, 3, 3]
    assert next(r for r in rows if r.doc_id == 9).n_hit == 3 and next(r for r in rows if r.doc_id == 7).n_hit == 1
    clean = D.remove_contaminated(df, items)
    assert clean.columns == df.columns
    assert clean.count() == df.count() - 4
    assert D.digest(D.contamination(df, items_of(spark, []))).where("contaminated").count() == 0
    assert D.digest(D.contamination(null_docs(spark), items)).count() == 2
    assert D.digest(D.contamination(empty_docs(spark), items)).count() == 0
    assert D.remove_contaminated(null_docs(spark), items).count() == 2


def test_no_python_in_the_plan(spark):
    docs, items = corpus(random.Random(5))
    plan = D.digest(D.contamination(docs_of(spark, docs), items_of(spark, items)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
