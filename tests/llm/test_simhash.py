import random

import pytest
import xxhash

from consentflow.llm import simhash as H
from consentflow.llm.common import prepare
from consentflow.llm.components import components
from tests.llm.helpers import docs_of, edge_docs, empty_docs, null_docs, words


def fingerprint_by_hand(text, shingle=3):
    ws = (text or "").encode().lower().split()
    if not ws:
        return 0
    grams = [b" ".join(ws[i:i + shingle]) for i in range(max(len(ws) - shingle + 1, 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_by_hand(fps, bits):
    """fps: (id, fingerprint) -> component id of each row, comparing all pairs."""
    root = {}
    for i, (_, a) in enumerate(fps):
        seen, todo = {i}, [i]
        while todo:
            j = todo.pop()
            for k, (_, b) in enumerate(fps):
                if k not in seen and (fps[j][1] ^ b).bit_count() <= bits:
                    seen.add(k)
                    todo.append(k)
        root[i] = min((fps[k][0] for k in seen if fps[k][0] is not None), default=None)
    return root


def test_fingerprints(spark):
    rng = random.Random(12)
    for n in [0, 1, 2, 3, 4, 5, 50, 400]:
        text = words(rng, n).upper() + " É \x0b"
        assert H.fingerprint(text, 3) == fingerprint_by_hand(text)
    assert H.fingerprint(None, 3) == H.fingerprint(" \n", 3) == 0


@pytest.mark.parametrize("bits,segments", [(2, 2), (2, 3), (3, 2), (4, 2)])
def test_links_are_all_pairs_within_the_distance(spark, bits, segments):
    rng = random.Random(bits)
    fps = {rng.getrandbits(64) for _ in range(15)}
    for f in list(fps):
        for _ in range(8):
            g = f
            for _ in range(rng.randint(1, bits + 2)):
                g ^= 1 << rng.randrange(64)
            fps.add(g)
    signed = {f: f - (1 << 64) if f >> 63 else f for f in fps}
    nodes = spark.createDataFrame([(s,) for s in signed.values()], "fp long")
    got = sorted((r.a, r.b) for r in H.links(nodes, bits, segments).collect())
    want = sorted({(min(signed[a], signed[b]), max(signed[a], signed[b])) for a in fps for b in fps if a != b and (a ^ b).bit_count() <= bits})
    assert sorted(set(got)) == want


def test_components_of_long_paths_and_stars(spark):
    prepare(spark)
    rng = random.Random(13)
    names = rng.sample(range(1000, 9000), 400)
    edges = list(zip(names[:200], names[1:200])) + [(names[200], x) for x in names[201:300]]
    rng.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {x: min(names[:200]) for x in names[:200]} | {x: min(names[200:300]) for x in names[200:300]}
    assert got == want


def test_groups_with_edges(spark):
    prepare(spark)
    rng = random.Random(14)
    base = [words(rng, 150, 400) for _ in range(5)]
    extra = []
    for i in range(60):
        w = base[i % 5].split()
        for _ in range(rng.choice([0, 0, 1, 2])):
            w[rng.randrange(len(w))] = "edit"
        extra.append((100 + i, " ".join(w)))
    df = edge_docs(spark, extra)
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    fps = [(i, fingerprint_by_hand(t)) for i, t in rows]
    want = groups_by_hand(fps, 2)
    got = H.digest(H.near_duplicates(df)).collect()
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == sorted(
        ((i, f"{f:016x}", want[k]) for k, (i, f) in enumerate(fps)), key=str)
    kept = H.deduplicate(df)
    assert kept.columns == df.columns
    component = groups_by_hand([(n, f) for n, (_, f) in enumerate(fps)], 2)  # by row number, so that it names a component
    assert kept.count() == len(set(component.values()))
    assert {r.doc_id for r in kept.select("doc_id").collect()} == set(want.values())
    # rows of equal id and text are one, of equal id and other text are not
    assert kept.where("doc_id = 4 AND text LIKE 'repeat%'").count() <= 1
    assert H.near_duplicates(null_docs(spark)).count() == 2 and H.deduplicate(null_docs(spark)).count() == 1
    assert H.near_duplicates(empty_docs(spark)).count() == 0 and H.deduplicate(empty_docs(spark)).count() == 0


def test_every_component_keeps_one_row_whatever_its_ids(spark):
    """Null ids and repeated ids with different texts, near copies among them."""
    prepare(spark)
    rng = random.Random(21)
    texts = [words(rng, 150, 400) for _ in range(8)]
    near = texts[0].split()
    near[70] = "edit"
    rows = [(None, t) for t in texts[:4]] + [(7, t) for t in texts[4:]] + [(None, texts[0]), (7, texts[4]), (9, texts[5]),
                                                                           (None, " ".join(near)), (None, None), (None, ""), (7, " ")]
    fps = [(n, fingerprint_by_hand(t)) for n, (_, t) in enumerate(rows)]
    component = groups_by_hand(fps, 2)  # by row number, so that it names a component
    df = docs_of(spark, rows)
    kept = [(r.doc_id, r.text) for r in H.deduplicate(df).collect()]
    by_text = {t: component[n] for n, (_, t) in enumerate(rows)}
    assert sorted(by_text[t] for _, t in kept) == sorted(set(component.values()))
    for i, t in kept:
        ids = [j for n, (j, _) in enumerate(rows) if component[n] == by_text[t]]
        assert i == min((j for j in ids if j is not None), default=None)
    assert H.deduplicate(null_docs(spark)).count() == 1 and H.deduplicate(empty_docs(spark)).count() == 0
