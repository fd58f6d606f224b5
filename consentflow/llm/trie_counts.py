"""Token counts by trie-shared dynamic programming (operator 3).

A unigram tokeniser splits every pre-token (a word with the word mark in front)
into the pieces of greatest total log-probability. The distinct pre-tokens of a
batch are put in a trie and the trie is walked once: the forward scores of a
node -- best score, its number of pieces, and the log-sum over all
segmentations -- depend on the prefix alone, so words that share a prefix share
them. The counts at the terminals are looked up for every document.

The pieces come from a public vocabulary; their log-probabilities follow Zipf's
law over the rank (the file's scores are ranks). Characters without a piece are
spelled in byte pieces.

Defined cases: null, empty and blank texts have no pre-tokens and score 0;
equal scores take fewer pieces; very long words cost their length times the
longest piece; repeated rows each give a row; an empty table
gives an empty result. One Arrow pass, no shuffle; the
store of terminals is emptied when full (time, never results).
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

MARK = "▁"
CACHE_WORDS = 500_000


class Unigram:
    """Pieces with log-probabilities, and the byte pieces' log-probability."""

    def __init__(self, logp: dict[str, float], byte_logp: float):
        self.logp, self.byte_logp = logp, byte_logp
        self.one = {p: lp for p, lp in logp.items() if len(p) == 1}
        lengths: dict[str, set[int]] = {}
        for p in logp:
            if len(p) > 1:
                lengths.setdefault(p[-3:], set()).add(len(p))
        # lengths of the pieces that end in these three (or are these two) characters
        self.lengths = {k: sorted(v) for k, v in lengths.items()}

    def spell(self, ch: str) -> tuple[float, int]:
        n = len(ch.encode("utf-8", "surrogatepass"))
        return n * self.byte_logp, n

    def terminals(self, words) -> dict[str, tuple[int, float, float]]:
        """For every distinct word: pieces, best score, log-sum of all scores.

        Sorted order is the trie's depth-first order: the columns kept on the
        stack are the nodes from the root to the current one."""
        best, count, total = [0.0], [0], [0.0]
        out: dict[str, tuple[int, float, float]] = {}
        before = ""
        get, single, ending = self.logp.get, self.one.get, self.lengths.get
        log1p, exp = math.log1p, math.exp
        for word in sorted(set(words)):
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            del best[shared + 1:], count[shared + 1:], total[shared + 1:]
            for i in range(shared + 1, len(word) + 1):
                lp, k = single(word[i - 1]), 1
                if lp is None:
                    lp, k = self.spell(word[i - 1])
                score, k, mass = best[i - 1] + lp, count[i - 1] + k, total[i - 1] + lp
                for n in (*ending(word[i - 2:i], ()), *(ending(word[i - 3:i], ()) if i > 2 else ())) if i > 1 else ():
                    if n <= i and (lp := get(word[i - n:i])) is not None:
                        s, c, t = best[i - n] + lp, count[i - n] + 1, total[i - n] + lp
                        if s > score or (s == score and c < k):
                            score, k = s, c
                        mass = t + log1p(exp(mass - t)) if t > mass else mass + log1p(exp(t - mass))
                best.append(score)
                count.append(k)
                total.append(mass)
            out[word] = (count[-1], best[-1], total[-1])
            before = word
        return out


@lru_cache(maxsize=2)
def load_unigram(path: str) -> Unigram:
    """Pieces of a sentencepiece vocabulary, in rank order, under Zipf's law."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    usable = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    pieces = [sp.id_to_piece(i) for i in usable if not sp.is_byte(i)]
    norm = math.log(math.fsum(1 / (r + 1) for r in range(len(usable))))
    zipf = lambda r: -math.log(r + 1) - norm
    return Unigram({p: zipf(r) for r, p in enumerate(pieces)}, zipf(len(usable) - 1))


@lru_cache(maxsize=1)
def _store(path: str) -> dict:
    return {}


def token_counts(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text",
                 cache_words: int = CACHE_WORDS) -> DataFrame:
    """id, n_pretokens, n_distinct, n_tokens, best_logp, forward_logp (natural logarithms)."""
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("t"))
    id_type = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = load_unigram(vocabulary_path), _store(vocabulary_path)
        for b in batches:
            if len(known) > cache_words:
                known.clear()
            counted = [Counter((t or "").split()) for t in b.column("t").to_pylist()]
            new = {MARK + w for c in counted for w in c if w not in known}
            known.update((w[1:], v) for w, v in model.terminals(new).items())
            cols: list[list] = [[] for _ in range(5)]
            for c in counted:
                tokens, best, mass = 0, 0.0, 0.0
                for w, n in c.items():
                    k, x, y = known[w]
                    tokens += n * k
                    best += n * x
                    mass += n * y
                for col, v in zip(cols, (c.total(), len(c), tokens, best, mass)):
                    col.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([b.column("id"), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                                             names=["id", "n_pretokens", "n_distinct", "n_tokens", "best_logp", "forward_logp"])

    return src.mapInArrow(run, f"id {id_type}, n_pretokens bigint, n_distinct bigint, n_tokens bigint, "
                               "best_logp double, forward_logp double").withColumnRenamed("id", id_col)
