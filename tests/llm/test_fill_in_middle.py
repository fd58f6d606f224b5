import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from consentflow.llm import fill_in_middle as M
from consentflow.llm import queries as Q
from consentflow.llm.common import prepare
from tests.llm.helpers import edge_docs, empty_docs, null_docs


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def by_hand(doc_id, text):
    """The contract on plain Python strings."""
    text = text or ""
    digest = sha(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(text)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    x, y, z = text[:a], text[a:b], text[b:]
    out = f"<S>{z}<P>{x}<M>{y}" if h4 % 100 < 20 else f"<P>{x}<S>{z}<M>{y}"
    return doc_id, n, "spm" if h4 % 100 < 20 else "psm", a, b - a, sha(out), sha(text)


def noise(rng, n):
    return "".join(rng.choice(["a", "<", ">", "P", "S", "é", "日", "😀", "\n", " ", "word"]) for _ in range(n))


def test_rolling_hash_reads_the_last_bytes_alone():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    h = M.rolling_hash(data)
    for i in (31, 100, 4999):
        want = sum(int(M._gear()[data[i - j]]) << j for j in range(32)) & 0xFFFFFFFF
        assert int(h[i]) == want


def test_marks_do_not_depend_on_blocks(monkeypatch):
    data = np.random.default_rng(2).integers(0, 256, 50_000).astype(np.uint8)
    whole = M.marks_of(data)
    monkeypatch.setattr(M, "BLOCK", 777)
    assert M.marks_of(data).tolist() == whole.tolist() and len(whole) > 20


def test_equal_passages_share_chunks():
    rng = random.Random(2)
    passage = noise(rng, 40_000)
    texts = [noise(rng, 3000) + passage, noise(rng, 7777) + passage + noise(rng, 100)]
    store = M.ChunkStore()
    for t in M._batch(pa.array(texts), store):
        assert t.units == len(t.data.decode())
    assert store.found > 0.5 * len(passage.encode()) / (M.LEAST + 1024)
    sizes = [b - a for t in M._batch(pa.array(texts), store) for a, b in zip(t.starts, t.ends)]
    assert max(sizes) <= M.MOST and min(sizes[:-1]) > 0


def test_store_compares_content(monkeypatch):
    monkeypatch.setattr(M, "hash", lambda x: 7, raising=False)  # every chunk of one fingerprint
    store = M.ChunkStore()
    for text in ("abc", "äöü", "x<S>", "abc"):
        assert store.summary(text.encode())[0] == len(text)
    assert store.refused == 3


def test_small_store_gives_the_same():
    rng = random.Random(3)
    texts = [noise(rng, rng.randrange(30_000)) for _ in range(20)]
    small, large = M.ChunkStore(limit=1), M.ChunkStore()
    for a, b in zip(M._batch(pa.array(texts), small), M._batch(pa.array(texts), large)):
        assert M.transform_text(a, 5) == M.transform_text(b, 5)


@pytest.mark.parametrize("at", [0, 1, 2, 3])
def test_sentinels_across_borders(at):
    data = b"x" * M.MOST * 2
    cut = M.MOST - at
    data = data[:cut] + b"<M>" + data[cut:]
    text = next(M._batch(pa.array([data.decode()]), M.ChunkStore()))
    assert text.sentinel
    tiny = M.ChunkedText(b"a<S>b", [1, 2, 3, 4, 5], M.ChunkStore())  # a sentinel over three chunks
    assert tiny.sentinel and tiny.units == 5
    assert not M.ChunkedText(b"a<Sb>", [1, 2, 3, 4, 5], M.ChunkStore()).sentinel


def test_brute_force_with_edges(spark):
    prepare(spark)
    rng = random.Random(4)
    extra = [(100 + i, noise(rng, rng.choice([1, 2, 3, 50, 5000, 60_000]))) for i in range(120)]
    extra += [(300 + i, t) for i, t in enumerate(["<P>", "a<S>", "<M", "<<S>", "<P", "S>", "😀", "<<", "<S<S"] * 4)]
    df = edge_docs(spark, extra)
    out = M.transform(df)
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = sorted(map(tuple, M.digest(out).collect()), key=str)
    want = sorted((by_hand(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=str)
    assert got == want
    assert {r[2] for r in want} == {"plain", "psm", "spm"}
    assert out.join(df.select("doc_id", "text").distinct(), "doc_id").where(
        "doc_id >= 100").where(~M.restored().eqNullSafe(F.col("text"))).count() == 0


def test_null_and_empty_tables(spark):
    prepare(spark)
    assert {tuple(r) for r in M.digest(M.transform(null_docs(spark))).collect()} == {by_hand(None, None)}
    assert M.digest(M.transform(empty_docs(spark))).count() == 0


def test_query_on_the_table(spark):
    sf = "/root/testdata/sf0.001"
    got = Q.QUERIES["op11_fill_in_middle"](spark, sf).collect()
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, got)) == sorted(by_hand(r.doc_id, r.text) for r in rows)
