import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from consentflow.llm import byte_bpe as B
from consentflow.llm.common import prepare
from tests.llm.helpers import docs_of, edge_docs, empty_docs, null_docs

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
PARTS = ["a", "b", "é", " ", "  ", "\n", "\n\n", "\t", ".", ",", "'s", "'", "'r", "e", "ll", "1", "\xa0", "日本", "!?", "　", " the", "aaaaaaaa"]


def test_chunks_stitch_to_the_whole_text():
    enc = B._encoding(RANKS, PATTERN)
    rng = random.Random(7)
    for _ in range(1500):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(1, 120)))
        chunk = rng.randint(9, 60)
        overlap = rng.randint(4, chunk - 1)
        got = [i for piece in B.encode_long(text, enc, PATTERN, chunk, overlap) for i in piece]
        assert got == enc.encode_ordinary(text), (text, chunk, overlap)


@pytest.mark.parametrize("chunk,overlap", [(40, 12), (17, 5), (200, 199)])
def test_distributed_chunks(spark, chunk, overlap):
    prepare(spark)
    rng = random.Random(chunk)
    rows = [(i, "".join(rng.choice(PARTS) for _ in range(rng.randint(1, 300)))) for i in range(60)]
    rows += [(100, "x" * 700), (101, " " * 500), (102, rows[0][1]), (0, rows[0][1]), (103, "1" * 40 + "a" * 400)]
    enc = B._encoding(RANKS, PATTERN)
    got = B.encode(docs_of(spark, rows), RANKS, PATTERN, chunk=chunk, overlap=overlap).collect()
    assert sorted((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in got) == sorted((i, enc.encode_ordinary(t)) for i, t in rows)


def test_digest_with_edges(spark):
    prepare(spark)
    df = edge_docs(spark)
    enc = B._encoding(RANKS, PATTERN)
    want = []
    for r in df.select("doc_id", "text").collect():
        ids = enc.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((r.text or "").encode()).hexdigest()))
    got = [tuple(r) for r in B.digest(B.encode(df, RANKS, PATTERN, chunk=5000), RANKS, PATTERN).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    decoded = B.decode(B.encode(df, RANKS, PATTERN), RANKS, PATTERN).collect()
    assert {bytes(r.decoded) for r in decoded} == {(r.text or "").encode() for r in df.collect()}
    assert B.encode(null_docs(spark), RANKS, PATTERN).count() == 2
    assert B.digest(B.encode(empty_docs(spark), RANKS, PATTERN), RANKS, PATTERN).count() == 0
