import random
import re

import pytest

from consentflow.llm import line_dedup as L
from consentflow.llm.common import prepare
from tests.llm.helpers import docs_of, edge_docs, empty_docs, null_docs


def sets_of(text):
    return [frozenset(w for w in re.split(r"[\x20\x09-\x0D]+", x) if w) for x in text.split("\n")]


def by_hand(rows, similarity):
    """Lines kept of every row (ids must differ), by comparing all lines."""
    before, out = [], {}
    for i, text in sorted((r for r in rows if r[1] is not None), key=lambda r: (r[0] is not None, r[0] or 0)):
        keep = []
        for line, s in zip(text.split("\n"), sets_of(text)):
            gone = bool(s) and any(len(s & b) >= similarity * len(s | b) - 1e-9 for b in before)
            if s:
                before.append(s)
            if not gone:
                keep.append(line)
        out[i] = "\n".join(keep)
    return out


def variants(rng, n):
    """Lines that are near copies of few originals, single words, blanks and strangers."""
    base = [[f"v{rng.randrange(60)}" for _ in range(rng.randint(1, 14))] for _ in range(6)]
    lines = []
    for _ in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            w[rng.randrange(len(w))] = f"u{rng.randrange(200)}"
        if rng.random() < 0.2:
            rng.shuffle(w)
        lines.append(rng.choice([" ".join(w), "  ".join(w), "", " ", "one", f"s{rng.randrange(9)} t{rng.randrange(9)}"]))
    return lines


@pytest.mark.parametrize("similarity,seed", [(0.8, 1), (0.8, 2), (0.6, 3), (1.0, 4)])
def test_agrees_with_all_pairs(spark, similarity, seed):
    prepare(spark)
    rng = random.Random(seed)
    rows = [(i, "\n".join(variants(rng, rng.randint(1, 8)))) for i in range(80)]
    rows += [(1000, None), (1001, ""), (None, rows[5][1] + "\nonly here at all now")]
    got = {r.doc_id: r.text for r in L.deduplicate(docs_of(spark, rows), similarity).collect()}
    want = by_hand(rows, similarity)
    assert got.pop(1000) is None
    assert got == want


def test_large_group_of_near_copies(spark):
    """A hot group: every line is a near copy of the first."""
    prepare(spark)
    rng = random.Random(11)
    base = [f"h{i}" for i in range(40)]
    rows = []
    for i in range(300):
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(40)] = f"e{rng.randrange(10_000)}"
        rows.append((i, " ".join(w)))
    got = {r.doc_id: r.text for r in L.deduplicate(docs_of(spark, rows)).collect()}
    assert got == by_hand(rows, 0.8)


def test_texts_of_many_lines(spark):
    """Near-equal lines of two long texts: no line's row holds its whole text."""
    prepare(spark)
    rng = random.Random(12)
    lines = [" ".join(f"g{rng.randrange(3000)}" for _ in range(12)) for _ in range(2500)]
    edited = [" ".join([*x.split()[:11], f"z{i}"]) for i, x in enumerate(lines)]
    got = {r.doc_id: r.text for r in L.deduplicate(docs_of(spark, [(1, "\n".join(lines)), (2, "\n".join(edited))])).collect()}
    assert got == {1: "\n".join(lines), 2: ""}


def test_edges_and_columns(spark):
    prepare(spark)
    df = edge_docs(spark)
    out = L.deduplicate(df)
    assert out.columns == df.columns and out.count() == df.count()
    rows = {r.doc_id: r.text for r in out.collect() if r.doc_id != 4}
    assert rows[1] is None and rows[2] == "" and rows[3] == " \t\n "
    assert rows[8] == "a\n\nb a\n"
    assert [r.text for r in out.where("doc_id = 4 AND text LIKE 'repeat%'").collect()] == ["repeat me please"] * 2  # one place
    extra = L.deduplicate(df, extra=True)
    assert extra.columns == [*df.columns, "n_lines", "n_removed"]
    assert L.deduplicate(null_docs(spark)).count() == 2
    assert L.deduplicate(empty_docs(spark)).count() == 0


@pytest.mark.parametrize("hot", [3, 40])
def test_split_words(spark, hot):
    """Words of many classes are split by size and into blocks: the same lines go."""
    prepare(spark)
    rng = random.Random(21)
    rows = []
    for i in range(150):
        w = ["all", "these"] + [f"q{rng.randrange(30)}" for _ in range(rng.randint(4, 16))]
        rows.append((i, " ".join(w)))
        if rng.random() < 0.4:
            w[rng.randrange(2, len(w))] = f"e{rng.randrange(9)}"
            rows.append((1000 + i, " ".join(w)))
    want = by_hand(rows, 0.6)
    removed = L.removed_lines(L._source(docs_of(spark, rows), "doc_id", "text"), 0.6, hot).collect()
    assert {r.id for r in removed} == {i for i, text in want.items() if text == ""}


def test_cut_lines_by_hand(spark):
    """Sets of whole texts, empty texts, all blanks, very long words."""
    texts = ["a b", "", "a b\n\nc\ta\x0bb ", "\n", "b a b", "x" * 70_000 + " y", "x" * 70_001 + " y", "é日 é"]
    rows = L.line_sets(spark.createDataFrame([(10 * i, t) for i, t in enumerate(texts)], "base bigint, t string"), 1).collect()
    rows = sorted(rows, key=lambda r: r.place)
    assert [(r.place // 10, r.place % 10, len(r.s)) for r in rows] == [
        (0, 0, 2), (2, 0, 2), (2, 2, 3), (4, 0, 2), (5, 0, 2), (6, 0, 2), (7, 0, 2)]
    names = [(r.h1, r.h2) for r in rows]
    assert names[0] == names[1] == names[3] and len(set(names)) == 5
    blank = spark.createDataFrame([(0, ""), (1, " "), (2, "\r\n\x0c\t")], "base bigint, t string")
    assert L.line_sets(blank, 1).count() == L.line_sets(blank.limit(0), 1).count() == 0


def test_dataframe_functions_alone(spark, monkeypatch):
    """No staged step and not the result runs Python on the executors."""
    prepare(spark)
    plans = []
    kept = L.stage

    def stage(df, name, **options):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return kept(df, name, **options)

    monkeypatch.setattr(L, "stage", stage)
    rng = random.Random(31)
    rows = [(i, "\n".join(variants(rng, 4))) for i in range(40)]
    out = L.deduplicate(docs_of(spark, rows), extra=True)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 5
    assert not [p for p in plans if any(x in p for x in ("MapInArrow", "MapInPandas", "Python", "ArrowEval", "InArrow", "InPandas"))]
    assert {r.doc_id: r.text for r in out.collect()} == by_hand(rows, 0.8)


def test_near_copies_leave_few_pairs(spark, monkeypatch):
    """The near pass settles a group, so that its classes do not all meet."""
    prepare(spark)
    counts = {}
    kept = L.stage

    def stage(df, name, **options):
        out = kept(df, name, **options)
        if name in ("line-pairs", "line-hot-pairs"):
            counts[name] = counts.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(L, "stage", stage)
    rng = random.Random(32)
    base = [f"h{i}" for i in range(40)]
    rows = []
    for i in range(400):
        w = list(base)
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(40)] = f"e{rng.randrange(10_000)}"
        rows.append((i, " ".join(w)))
    got = {r.doc_id: r.text for r in L.deduplicate(docs_of(spark, rows)).collect()}
    assert got == by_hand(rows, 0.8)
    assert sum(counts.values()) < 20 * len(rows)
