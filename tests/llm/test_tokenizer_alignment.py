import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from consentflow.llm import queries as Q
from consentflow.llm import tokenizer_alignment as A
from consentflow.llm.common import prepare
from tests.llm.helpers import edge_docs, empty_docs, null_docs

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class ByHand:
    """The contract, text by text and offset by offset."""

    def __init__(self):
        self.a = Tokenizer.from_file(PATHS[0])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
        self.names = {i: t for t, i in self.a.get_vocab().items()}
        self.alphabet = A.byte_alphabet()

    def groups(self, text):
        """List of (A ids, B ids); none for a text without tokens."""
        if not text:
            return []
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        x = [bytes(self.alphabet[c] for c in self.names[i]) for i in a]
        y = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
             for i, p in ((i, self.b.id_to_piece(i)) for i in b)]
        if b"".join(x) != (" " + text).encode() or b"".join(y) != (" " + text).encode():
            return []
        ends_a, ends_b = np.cumsum([len(t) for t in x]), np.cumsum([len(t) for t in y])
        cuts = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
        out, i, j = [], 0, 0
        for c in cuts:
            i2, j2 = int(np.searchsorted(ends_a, c, "right")), int(np.searchsorted(ends_b, c, "right"))
            out.append((a[i:i2], b[j:j2]))
            i, j = i2, j2
        return out

    def table(self, rows):
        found = [(d, self.groups(t)) for d, t in rows]
        counts = Counter((g[0][-1], g[1][-1]) for _, gs in found for g in gs)
        top = {}
        for (_, b), n in counts.items():
            top[b] = max(top.get(b, 0), n)
        out = []
        for d, gs in found:
            said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in gs)
            links = [(a[-1], b[-1]) for a, b in gs]
            out.append((d, sum(len(a) for a, _ in gs), sum(len(b) for _, b in gs), len(gs), len(links),
                        sum(counts[x] == top[x[1]] for x in links), sum(counts[x] for x in links),
                        hashlib.sha256(said.encode()).hexdigest() if gs else ""))
        return out


@pytest.fixture(scope="module")
def by_hand():
    return ByHand()


def noise(rng):
    parts = ["a", "b", "é", " ", " ", "  ", "\n", "\t", ".", "'s", "1", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>", "▁", "\xa0",
             "日本", "😀", "ﬁ", "\x00", "​", "\r\n", " the", " international", "Straße", "é", "﻿", "　"]
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))


def test_units_align_like_whole_texts(by_hand):
    rng = random.Random(6)
    texts = [noise(rng) for _ in range(6000)]
    aligner = A.Aligner(*PATHS, limit=40)
    assert aligner.cuts
    got = [x for i in range(0, len(texts), 700) for x in aligner.texts(pa.array(texts[i:i + 700]))]
    found = 0
    for text, x in zip(texts, got):
        gs = by_hand.groups(text)
        said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in gs)
        assert (x[4][:-1].decode() if x else "") == said, repr(text)
        assert (x[0] if x else 0) == sum(len(a) for a, _ in gs)
        found += bool(gs)
    assert 1000 < found < 6000  # texts with other bytes in B (a literal of its space) have none


def test_identity_map_names_equal_bytes():
    aligner = A.Aligner(*PATHS)
    has = np.flatnonzero(aligner.same >= 0)
    assert len(has) > 10_000
    assert all(aligner.a_bytes[i] == aligner.b_bytes[aligner.same[i]] for i in has.tolist())


@pytest.mark.parametrize("heavy", [1, 50, 1 << 16])
def test_brute_force_with_edges(spark, by_hand, monkeypatch, heavy):
    """With all, some and no irregular pairs counted by shuffle alone."""
    monkeypatch.setattr(A, "HEAVY", heavy)
    prepare(spark)
    rng = random.Random(7)
    pool = ["Verschluesselung", "constantinople", "running", "zig-zag", "l'amour", "naïve", "42", "don't", "x86_64", "日本語"]
    extra = [(500 + i, " ".join(rng.choices(pool, k=rng.randint(1, 60)))) for i in range(60)] + [(900 + i, noise(rng)) for i in range(200)]
    df = edge_docs(spark, extra)
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    got = sorted(map(tuple, A.digest(df, *PATHS).collect()), key=str)
    assert got == sorted(by_hand.table(rows), key=str)


def test_null_and_empty_tables(spark):
    prepare(spark)
    assert [tuple(r) for r in A.digest(null_docs(spark), *PATHS).collect()] == [(None, 0, 0, 0, 0, 0, 0, "")] * 2
    assert A.digest(empty_docs(spark), *PATHS).count() == 0


def test_query_on_the_table(spark, by_hand):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = Q.QUERIES["op12_tokenizer_alignment"](spark, sf)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(by_hand.table(rows))
