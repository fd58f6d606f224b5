import math
import random
import re
from collections import Counter

import pytest
import xxhash

from consentflow.llm import quality_rules as Q
from consentflow.llm.common import prepare
from tests.llm.helpers import docs_of, edge_docs, empty_docs, null_docs, words

BLANK = re.compile(r"[\x20\x09-\x0D]+")


def words_by_hand(text):
    return [w for w in BLANK.split(text or "") if w]


def base_by_hand(text):
    text = text or ""
    ws = words_by_hand(text)
    grams = Counter(tuple(ws[i:i + 3]) for i in range(len(ws) - 2))
    hit = {i + k for i in range(len(ws) - 2) if grams[tuple(ws[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if words_by_hand(x)]
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def features_by_hand(text, buckets):
    ws = words_by_hand(text)
    h = lambda w, seed=42: xxhash.xxh64_intdigest(w.encode(), seed)
    return [signed(h(w)) % buckets for w in ws] + [signed(h(b, h(a))) % buckets for a, b in zip(ws, ws[1:])]


def ratios_by_hand(rows, trusted, buckets, smooth):
    raw, target = Counter(), Counter()
    for i, t in rows:
        f = features_by_hand(t, buckets)
        raw.update(f)
        if i in trusted:
            target.update(f)
    r_all, t_all = sum(raw.values()), sum(target.values())
    w = {b: math.log((target[b] + smooth * n / r_all) / (t_all + smooth)) - math.log(n / r_all) for b, n in raw.items()} if t_all else {}
    out = {}
    for i, t in rows:
        f = features_by_hand(t, buckets)
        out[i] = sum(w.get(b, 0.0) for b in f) / len(f) if f else 0.0
    return out


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_base_and_ratio_agree_with_plain_python(spark):
    prepare(spark)
    rng = random.Random(8)
    rows = [(i, words(rng, rng.randint(0, 200), 30) + rng.choice(["", "\nline\nline\n \n", " | # |", " é\x0bü"])) for i in range(40)]
    trusted = set(range(0, 40, 3))
    labels = [(i, int(i in trusted), 0) for i in range(40)] + [(3, 0, 0), (None, 1, 0), (5, None, 0)]
    trusted.discard(3)  # labelled both ways
    got = Q.quality_rules(docs_of(spark, rows), labels_of(spark, labels), buckets=64, smooth=5.0, min_ratio=0.0).collect()
    want = ratios_by_hand(rows, trusted, 64, 5.0)
    texts = dict(rows)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base_by_hand(texts[r.doc_id])
        assert r.ratio == pytest.approx(want[r.doc_id], abs=1e-9)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and r.ratio >= 0.0)
    assert {r.kept for r in got} == {True, False}


def test_junk_goes_and_clean_stays(spark):
    prepare(spark)
    rng = random.Random(9)
    clean = [(i, words(rng, 300, 2000)) for i in range(60)]
    junk = [(100 + i, " ".join(f"z{rng.randrange(50)}%%%" for _ in range(300))) for i in range(20)]
    labels = labels_of(spark, [(i, 1, 0) for i in range(30)] + [(100 + i, 0, 0) for i in range(10)])
    kept = {r.doc_id for r in Q.quality_rules(docs_of(spark, clean + junk), labels, smooth=1000.0, buckets=500).where("kept").collect()}
    assert kept == {i for i, _ in clean}


def test_edges(spark):
    prepare(spark)
    none = labels_of(spark, [])
    df = edge_docs(spark)
    rows = Q.quality_rules(df, none).collect()
    assert len(rows) == df.count() and all(r.ratio == 0.0 for r in rows)
    assert all(r.n_words == 0 and r.base_failed for r in rows if r.doc_id in (1, 2, 3))
    long = next(r for r in rows if r.doc_id == 5)
    assert long.n_words == 30_000 and long.n_repeat_words == base_by_hand(df.where("doc_id = 5").first().text)[4]
    for r in df.select("doc_id", "text").collect():
        assert base_by_hand(r.text) in [(x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words)
                                        for x in rows if x.doc_id == r.doc_id]
    assert Q.quality_rules(null_docs(spark), none).count() == 2
    assert Q.quality_rules(empty_docs(spark), none).count() == 0


def test_no_python_in_the_plan(spark):
    plan = Q.quality_rules(edge_docs(spark), labels_of(spark, [(1, 1, 0)]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
