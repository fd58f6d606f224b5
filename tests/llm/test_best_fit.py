import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from consentflow.llm import best_fit as B
from consentflow.llm import queries as Q
from consentflow.llm.common import prepare
from tests.llm.helpers import edge_docs, empty_docs, null_docs

PATH = public_tokenizers.path("byte_bpe_50k.json")


def best_fit_by_hand(lengths, capacity):
    """Used ids of each window: every piece looks at every window."""
    windows = []
    for x in sorted(lengths, reverse=True):
        fits = [(capacity - w, i) for i, w in enumerate(windows) if capacity - w >= x]
        if fits:
            windows[min(fits)[1]] += x
        else:
            windows.append(x)
    return windows


def sequences_of(lengths, capacity, max_gap):
    """(sequence, offset, piece, from, to) of every piece by the plan."""
    counts, number = defaultdict(int), []
    for x in lengths:
        number.append(counts[x])
        counts[x] += 1
    plan = B.Plan(dict(counts), capacity, max_gap)
    if not lengths:
        return []
    keeps, to, offset = plan.place(np.array(lengths), np.array(number))
    out = []
    for i, (k, t, o) in enumerate(zip(keeps.tolist(), to.tolist(), offset.tolist())):
        out += [(t, o, i, 0, lengths[i])] if k else [(s, f, i, x, y) for s, f, x, y in plan.cut(t, lengths[i])]
    return out


def check(rows, lengths, capacity, max_gap):
    """Rows (sequence, offset, piece, from, to): gapless, whole, little padding."""
    by_seq, by_piece = defaultdict(list), defaultdict(list)
    for s, o, i, x, y in rows:
        assert y > x
        by_seq[s].append((o, y - x))
        by_piece[i].append((x, y))
    for parts in by_seq.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity and (capacity - at <= max_gap or at & (at - 1) == 0)
    assert sorted(by_seq) == list(range(len(by_seq)))
    for i, n in enumerate(lengths):
        at = 0
        for x, y in sorted(by_piece[i]):
            assert x == at
            at = y
        assert at == n


def test_tree_finds_the_tightest():
    rng = random.Random(1)
    for capacity in (1, 2, 7, 8, 100):
        tree, held = B.CapacityTree(capacity), set()
        for step in range(300):
            c = rng.randint(0, capacity)
            if c in held and rng.random() < 0.5:
                tree.pop(c)
                held.discard(c)
            elif c not in held:
                tree.push(c, (step, 1))
                held.add(c)
            least = rng.randint(0, capacity)
            assert tree.tightest(least) == min((x for x in held if x >= least), default=None)


@pytest.mark.parametrize("capacity", [1, 2, 5, 16, 64])
def test_plan_is_best_fit_decreasing(capacity):
    rng = random.Random(capacity)
    for _ in range(150):
        lengths = [rng.randint(1, rng.choice([capacity, max(1, capacity // 3)])) for _ in range(rng.randint(0, 80))]
        rows = sequences_of(lengths, capacity, capacity)  # all windows stay as they are
        used = defaultdict(int)
        for s, _, _, x, y in rows:
            used[s] += y - x
        assert sorted(used.values()) == sorted(best_fit_by_hand(lengths, capacity))
        for gap in (0, 1, 4):
            check(sequences_of(lengths, capacity, gap), lengths, capacity, gap)


def test_hot_length_needs_few_rules():
    plan = B.Plan({700: 10**12, 300: 10**6, 1: 10**11}, 1024, 4)
    assert len(plan.rules) < 20
    check(sequences_of([700] * 999, 1024, 4), [700] * 999, 1024, 4)


def check_rows(got, docs, capacity=1024, gap=4):
    """Result rows against ids by the library."""
    tok = Tokenizer.from_file(PATH)
    want = defaultdict(int)
    for d, t in docs:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        want[d, tuple(ids)] += 1
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id, r.doc_tokens].append(r)
        by_seq[r.sequence_id].append((r.offset, r.length))
    total = 0
    for parts in by_seq.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity and (capacity - at <= gap or at & (at - 1) == 0)
        total += at
    assert total == sum(len(ids) * n for (_, ids), n in want.items())
    for (d, ids), n in want.items():
        same = sum(m for (d2, other), m in want.items() if d2 == d and len(other) == len(ids))
        pieces = by_doc[d, len(ids)]
        covered = defaultdict(int)
        crc = {(r.start, r.length, r.ids_crc32) for r in pieces}
        for r in pieces:
            covered[r.start] += 1
            covered[r.start + r.length] -= 1
        at = 0
        for k in sorted(covered)[:-1]:
            at += covered[k]
            assert at == same
        if same == n:
            assert crc == {(s, k, zlib.crc32(np.array(ids[s:s + k], "<u4").tobytes())) for s, k, _ in crc}


def test_documents_with_edges(spark):
    prepare(spark)
    rng = random.Random(8)
    extra = [(1000 + i, " ".join(rng.choice(["alpha", "beta", "gamma", "<|endoftext|>"]) for _ in range(rng.choice([0, 1, 5, 300, 700])))) for i in range(150)]
    df = edge_docs(spark, extra)
    docs = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    check_rows(B.digest(B.pack(df, PATH)).collect(), docs)
    rows = B.pack(df, PATH, capacity=64, max_gap=0)
    check_rows(B.digest(rows).collect(), docs, 64, 0)
    wide = B.pack(df, PATH, end_id=1 << 20).selectExpr("explode(pieces) p").selectExpr("length(p.ids) / p.length AS w").distinct().collect()
    assert [r.w for r in wide] == [4.0]


def test_null_and_empty_tables(spark):
    prepare(spark)
    assert [(r.doc_id, r.length, r.doc_tokens) for r in B.digest(B.pack(null_docs(spark), PATH)).collect()] == [(None, 1, 1)] * 2
    assert B.digest(B.pack(empty_docs(spark), PATH)).count() == 0


def test_query_on_the_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    check_rows(Q.QUERIES["op13_best_fit"](spark, sf).collect(), [tuple(r) for r in rows])


def test_odd_texts_keep_their_place_between_others():
    """Units of texts that need Python stand among those split by Arrow, and no
    list of the others' units is made."""
    import pyarrow as pa

    from consentflow.llm import token_output as O

    texts = ["a b", " x  y", "", "c", "tab\there", "d e f"]
    texts = pa.array(texts * 3, pa.large_string())
    plain = O.units
    seen = []
    try:
        O.units = lambda t: seen.append(t) or plain(t)
        offsets, words = O.split_units(texts[1:])
    finally:
        O.units = plain
    words = words.to_pylist()
    got = [words[a:b] for a, b in zip(offsets, offsets[1:])]
    odd = {" x  y", "tab\there"}
    assert set(seen) == odd
    assert got == [plain(t) if t in odd else t.split(" ") for t in texts.to_pylist()[1:]]


def test_parts_of_a_batch_are_let_go():
    """While a larger batch is worked on, the batches that it was put together
    from are not held."""
    import gc
    import weakref

    import pyarrow as pa

    from consentflow.llm.token_output import larger_batches

    alive = []

    def batches():
        for i in range(4):
            b = pa.RecordBatch.from_pydict({"t": ["x" * 100] * 10})
            alive.append(weakref.ref(b))
            yield b
            del b

    for whole in larger_batches(batches(), 1500):
        gc.collect()
        assert whole.num_rows == 20 and not any(r() is not None for r in alive[:-1])  # the source has the last
