import math
import random

import public_tokenizers

from consentflow.llm import trie_counts as C
from consentflow.llm.common import prepare
from tests.llm.helpers import edge_docs, empty_docs, null_docs

PATH = public_tokenizers.path("piece_bpe_32k.model")


def brute(model, word):
    """All segmentations: (fewest pieces at the best score, best score, log-sum)."""
    ways = []

    def walk(i, score, n):
        if i == len(word):
            ways.append((score, -n))
            return
        for j in range(i + 1, len(word) + 1):
            if (lp := model.logp.get(word[i:j])) is not None:
                walk(j, score + lp, n + 1)
        if word[i] not in model.logp:
            lp, k = model.spell(word[i])
            walk(i + 1, score + lp, n + k)
    walk(0, 0.0, 0)
    top = max(w[0] for w in ways)
    best = max(w[0] for w in ways)
    return best, top + math.log(math.fsum(math.exp(w[0] - top) for w in ways)), ways


def test_terminals_agree_with_all_segmentations():
    rng = random.Random(6)
    model = C.Unigram({p: -rng.uniform(0.5, 6) for p in ("a", "b", "c", "ab", "bc", "abc", "ca", "cab", "bb", "▁", "▁a", "▁ab", "aabb")}, -9.0)
    words = {C.MARK + "".join(rng.choice("abcé") for _ in range(rng.randint(0, 8))) for _ in range(300)}
    got = model.terminals(words)
    assert set(got) == words
    for w in words:
        best, total, ways = brute(model, w)
        n, score, mass = got[w]
        assert math.isclose(score, best, abs_tol=1e-9) and math.isclose(mass, total, abs_tol=1e-9), w
        assert any(math.isclose(s, best, abs_tol=1e-9) and -k == n for s, k in ways)


def test_equal_scores_take_fewer_pieces():
    model = C.Unigram({"a": -1.0, "aa": -2.0}, -9.0)
    assert model.terminals({"aaaa"})["aaaa"][:2] == (2, -4.0)


def test_counts_with_edges(spark):
    prepare(spark)
    df = edge_docs(spark)
    model = C.load_unigram(PATH)
    texts = {}
    rows = C.token_counts(df, PATH, cache_words=3).collect()
    assert len(rows) == df.count()
    for r in df.select("doc_id", "text").collect():
        texts.setdefault(r.doc_id, []).append((r.text or "").split())
    for r in rows:
        options = []
        for ws in texts[r.doc_id]:
            t = model.terminals({C.MARK + w for w in ws})
            options.append((len(ws), len(set(ws)), sum(t[C.MARK + w][0] for w in ws), sum(t[C.MARK + w][1] for w in ws)))
        assert any((r.n_pretokens, r.n_distinct, r.n_tokens) == o[:3] and math.isclose(r.best_logp, o[3], rel_tol=1e-9, abs_tol=1e-9)
                   for o in options)
        assert r.forward_logp >= r.best_logp - 1e-6
    assert C.token_counts(null_docs(spark), PATH).count() == 2
    assert C.token_counts(empty_docs(spark), PATH).count() == 0
