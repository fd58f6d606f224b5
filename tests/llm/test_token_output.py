import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from consentflow.llm import token_output as T
from consentflow.llm.common import prepare
from tests.llm.helpers import edge_docs, empty_docs, null_docs

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("values", [[], [0], [7], [0, 0, 0], [1, 1, 2, 1000], list(range(500)), [10**9, 10**9, 2 * 10**9]])
def test_elias_fano_returns_every_value(values):
    ef = T.EliasFano.of(values)
    assert ef.all().tolist() == values
    assert [ef.get(k) for k in range(len(values))] == values


def test_elias_fano_random_and_small():
    rng = random.Random(4)
    for _ in range(30):
        v = sorted(rng.randrange(1 << rng.randint(1, 33)) for _ in range(rng.randint(1, 700)))
        ef = T.EliasFano.of(v)
        assert ef.all().tolist() == v and all(ef.get(k) == v[k] for k in rng.sample(range(len(v)), min(50, len(v))))
    v = np.cumsum([random.Random(i).randrange(1, 2000) for i in range(5000)])
    ef = T.EliasFano.of(v)
    bits = 8 * (len(ef.low) + len(ef.high) + len(ef.select)) / len(v)
    assert bits < 2 + np.log2(v[-1] / len(v)) + 2  # near the bound, far from 64


def test_units_encode_like_whole_texts():
    rng = random.Random(5)
    tok = Tokenizer.from_file(PATH)
    parts = ["a", "b", "é", " ", "  ", "\n", "\n\n", "\t", ".", ",", "'s", "'", "1", "<|endoftext|>", "\xa0", "日本", "!?", "　", " the"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    enc = T.UnitEncoder(PATH, limit=50)
    got = [x for i in range(0, len(texts), 500) for x in enc.encode(pa.array(texts[i:i + 500]))]
    for text, x in zip(texts, got):
        assert np.frombuffer(x, enc.kind).tolist() == tok.encode(text, add_special_tokens=False).ids, text


def test_added_tokens_in_texts():
    tok = Tokenizer.from_file(PATH)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y z", " <|endoftext|>  q", "a\t<|endoftext|>\n<|endoftext|> <|endoftext|> e"]
    kind = T.UnitEncoder(PATH).kind
    assert [np.frombuffer(x, kind).tolist() for x in T.UnitEncoder(PATH).encode(pa.array(texts))] == [
        tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert 50256 in tok.encode(texts[0], add_special_tokens=False).ids
    tok.encode_special_tokens = True
    assert [np.frombuffer(x, kind).tolist() for x in T.UnitEncoder(PATH, plain_special=True).encode(pa.array(texts))] == [
        tok.encode(t, add_special_tokens=False).ids for t in texts]


def by_hand(rows, end=2):
    """Sorted by id (nulls first), then by the text's fingerprint order given."""
    tok = Tokenizer.from_file(PATH)
    out, start = [], 0
    for doc_id, text in rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [end]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_round_trip_with_edges(spark):
    prepare(spark)
    df = edge_docs(spark)
    got = T.token_output(df, PATH, segment_ids=500).orderBy("start").collect()
    from pyspark.sql import functions as F
    ordered = df.orderBy("doc_id", F.xxhash64(F.coalesce("text", F.lit("")))).select("doc_id", "text").collect()
    assert [tuple(r) for r in got] == by_hand([tuple(r) for r in ordered])
    assert T.token_output(null_docs(spark), PATH).count() == 2
    assert T.token_output(empty_docs(spark), PATH).count() == 0


def test_wide_end_id(spark):
    prepare(spark)
    segments = T.encode_segments(edge_docs(spark), PATH, end_id=1 << 20)
    assert {r.width for r in segments.select("width").distinct().collect()} == {4}
    assert T.read_documents(segments).agg({"n_tokens": "sum"}).first()[0] == segments.agg({"n_ids": "sum"}).first()[0]
