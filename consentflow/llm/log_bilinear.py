"""Language-model scoring with a log-bilinear neural model (operator 10).

The corpus is gathered by Spark over all training documents: word counts, and
counts of all (context, next) pairs of classes. A class is one of the most
frequent words, or the words beyond them that share their last three bytes'
hash, or the begin and end of texts; every word is in one, as a context and as
a next token. Without a given ``vocab`` their number grows with the cube root
of the distinct training words (``growth`` times it for words of their own,
half as many for the others), so the table of pairs grows with the corpus, but
less than the corpus does. The pair counts are sufficient for a log-bilinear
model of one context: score(h, w) = (C r_h) . q_w + b_w with class vectors of
``dims`` dimensions, so training in numpy sees every training token whatever
its number. It goes over mini-batches of contexts. Noise-contrastive estimation
takes its expectation over the noise (unigram) distribution in closed form
instead of drawing samples, hence is deterministic. Batched matrix products
give each context's normaliser, once; at scoring the products of a text's
vectors less the normalisers are log-probabilities of its tokens.

A word beyond those of their own has, times its class's probability, its own
share of the class under the smoothed unigram model, so that the model is
normalised over all training words, one unknown word of each class and the end.

Counts of words that are frequent (at most ``head`` of them) go to every task;
counts of the others are joined by word, so no join key is frequent in training
text, and the joins move the rare words alone.

Defined cases: a null or empty text is the end alone; a null id is training
text; repeated rows each give a row; words of equal count are ranked by name; an
empty table gives an empty result; a very long text is scored in slices; with no
training text every token is unknown; extra columns are ignored.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from consentflow.llm.common import stage, text_key

FLUSH = 400_000
PAIRS = 4_000_000
SLICE = 1 << 16


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words between ASCII blanks, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def word_counts(train: DataFrame) -> DataFrame:
    """Word (bytes as text) and count over texts ``t``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary()).cast(pa.string()),
                                               pa.array(list(c.values()), pa.int64())], names=["w", "n"])
        for b in batches:
            for t in b.column("t").to_pylist():
                c.update(words_of(t))
            if len(c) > FLUSH:
                yield out()
                c.clear()
        yield out()
    return train.select("t").mapInArrow(run, "w string, n bigint").groupBy("w").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, most: int) -> list[tuple[str, int]]:
    """The words of at least the least count that leaves ``most`` or fewer,
    most frequent first."""
    by = sorted(((r.n, r.words) for r in counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).collect()), reverse=True)
    total, cut = 0, None
    for n, words in by:
        total += words
        if total > most:
            break
        cut = n
    if cut is None:
        return []
    rows = counts.where(F.col("n") >= cut).toPandas().sort_values(["n", "w"], ascending=[False, True])
    return list(zip(rows["w"], rows["n"].astype(int)))


def class_of(word: bytes, classes: int) -> int:
    """Class of a word without one of its own."""
    return zlib.crc32(word[-3:]) % classes


def class_counts(counts: DataFrame, own: list[tuple[str, int]], classes: int) -> np.ndarray:
    """Counts of the words without a class of their own, each and an unknown
    word half a count more, by class."""
    tail = F.crc32(F.substring(F.col("w").cast("binary"), -3, 3)) % classes
    mass = np.full(classes, 0.5)
    for r in counts.groupBy(tail.alias("class")).agg(F.sum(F.col("n") + 0.5).alias("n")).collect():  # a row a class
        mass[r["class"]] += r.n
    for w, n in own:
        mass[class_of(w.encode(), classes)] -= n + 0.5
    return mass


def pair_counts(train: DataFrame, ids: dict[bytes, int], size: int, classes: int = 1) -> DataFrame:
    """Counts of (context, next) over texts ``t``, apart for ``dev``: ids,
    ``size`` and on for the classes of other words, then one for the begin as a
    context and the end as a next token."""
    width = size + classes + 1
    sent = train.sparkSession.sparkContext.broadcast(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        at, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        held: list[np.ndarray] = []

        def merged():
            new, times = np.unique(np.concatenate([at[:0], *held]), return_counts=True)
            both, back = np.unique(np.concatenate([at, new]), return_inverse=True)
            return both, np.bincount(back, np.concatenate([n, times]), len(both)).astype(np.int64)

        def out():
            return pa.RecordBatch.from_arrays([pa.array(at), pa.array(n)], names=["pair", "n"])
        for b in batches:
            flat: list[int] = [width - 1]
            parts: list[int] = []
            for t, dev in zip(b.column("t").to_pylist(), b.column("dev").to_pylist()):
                own = [i if (i := known.get(w)) is not None else size + class_of(w, classes) for w in words_of(t)]
                flat += own
                flat.append(width - 1)  # this text's end and the next one's begin
                parts += [dev] * (len(own) + 1)
            a = np.array(flat, np.int64)
            held.append((np.array(parts, np.int64) * width + a[:-1]) * width + a[1:])
            if sum(map(len, held)) > PAIRS // 4:
                at, n = merged()
                held.clear()
            if len(at) > PAIRS:
                yield out()
                at, n = at[:0], n[:0]
        at, n = merged()
        yield out()
    return train.select("t", "dev").mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


class Pairs:
    """(context, next) counts by cell of a square table, in blocks of rows.

    Classes are numbered by falling frequency, so blocks of every so many rows
    are alike."""

    def __init__(self, width: int, cell: np.ndarray, n: np.ndarray, block: int = 512):
        self.width, self.blocks = width, max(1, -(-width // block))
        context, following = cell // width, cell % width
        order = np.argsort(context % self.blocks, kind="stable")
        self.context, self.following, self.n = context[order], following[order], n[order].astype(float)
        self.ends = np.concatenate([[0], np.cumsum(np.bincount(context % self.blocks, minlength=self.blocks))])
        self.of_context = np.bincount(self.context, self.n, width)
        self.of_following = np.bincount(self.following, self.n, width)

    @classmethod
    def of(cls, table: Pairs | np.ndarray) -> Pairs:
        if isinstance(table, cls):
            return table
        at = np.flatnonzero(table)
        return cls(len(table), at, np.ravel(table)[at])

    def rows(self, j: int) -> slice:
        return slice(j, self.width, self.blocks)

    def block(self, j: int) -> np.ndarray:
        s = slice(self.ends[j], self.ends[j + 1])
        n = len(range(self.width)[self.rows(j)])
        return np.bincount(self.context[s] // self.blocks * self.width + self.following[s], self.n[s],
                           n * self.width).reshape(n, self.width)


def log_softmax(m: dict, rows: slice = slice(None)) -> np.ndarray:
    s = (m["r"][rows] * m["c"]) @ m["q"].T + m["b"]
    s -= s.max(1, keepdims=True)
    return s - np.log(np.exp(s).sum(1, keepdims=True))


def fit(pairs: Pairs | np.ndarray, dev: Pairs | np.ndarray | None = None, dims: int = 24, noise: int = 10, steps: int = 160,
        rate: float = 0.03, seed: int = 7) -> tuple[dict, int]:
    """Noise-contrastive estimation from (context, next) counts, from the
    unigram model on, a block of contexts a step. With ``dev``, the step after
    which its likelihood is greatest (of those looked at) and the parameters of
    that step."""
    pairs = Pairs.of(pairs)
    dev = None if dev is None else Pairs.of(dev)
    width, blocks = pairs.width, pairs.blocks
    total = max(float(pairs.n.sum()), 1.0)
    unigram = (pairs.of_following + 0.5) / (pairs.n.sum() + 0.5 * width)
    context = pairs.of_context / total
    rng = np.random.default_rng(seed)
    m = {"r": rng.normal(0, 0.3, (width, dims)), "q": np.zeros((width, dims)), "c": np.ones(dims), "b": np.log(unigram)}
    shift = np.log(noise * unigram)
    first = {k: np.zeros_like(v) for k, v in m.items()}
    second = {k: np.zeros_like(v) for k, v in m.items()}
    best = (-math.inf, 0, m)
    look = max(10, 4 * blocks)
    for step in range(steps + 1):
        if dev is not None and step % look == 0:
            found = sum(float((dev.block(j) * log_softmax(m, dev.rows(j))).sum()) for j in range(dev.blocks))
            if found > best[0]:
                best = (found, step, {k: v.copy() for k, v in m.items()})
        if step == steps:
            break
        j = step % blocks
        here = pairs.rows(j)
        r, everywhere = m["r"][here], slice(None)
        h = r * m["c"]
        post = 1.0 / (1.0 + np.exp(-(h @ m["q"].T + m["b"] - shift)))  # taken for data, not noise
        slope = pairs.block(j) * ((1.0 - post) / total) - (noise * context[here, None] * unigram) * post
        gh = slope @ m["q"]
        grad = {"r": gh * m["c"], "c": (gh * r).sum(0), "q": slope.T @ h, "b": slope.sum(0)}
        for k, g in grad.items():
            at, t = (here, step // blocks + 1) if k == "r" else (everywhere, step + 1)
            first[k][at] = 0.9 * first[k][at] + 0.1 * g
            second[k][at] = 0.99 * second[k][at] + 0.01 * g * g
            m[k][at] += rate * (first[k][at] / (1 - 0.9 ** t)) / (np.sqrt(second[k][at] / (1 - 0.99 ** t)) + 1e-8)
    return (best[2], best[1]) if dev is not None else (m, steps)


def log10_table(m: dict, rows: int = 256) -> np.ndarray:
    """Normalised log10 probabilities of every next token, by context: batched
    matrix products and a log-softmax."""
    return np.concatenate([log_softmax(m, slice(i, i + rows)) for i in range(0, len(m["r"]), rows)]) / math.log(10)


def normalisers(m: dict, rows: int = 256) -> np.ndarray:
    """Natural logarithm of the sum over all next tokens, by context."""
    out = []
    for i in range(0, len(m["r"]), rows):
        s = (m["r"][i:i + rows] * m["c"]) @ m["q"].T + m["b"]
        top = s.max(1)
        out.append(top + np.log(np.exp(s - top[:, None]).sum(1)))
    return np.concatenate(out)


class Model:
    """What a task needs: frequent words' ids and counts, and the parameters.
    ``mass`` holds the counts of ``class_counts``; without it the words beyond
    ``size`` are one class."""

    def __init__(self, head: list[tuple[str, int]], size: int, params: dict, n_train: int, n_types: int, end_count: int,
                 mass: np.ndarray | None = None):
        self.words = [w.encode() for w, _ in head]
        self.counts = np.array([n for _, n in head] + [0], np.int64)
        self.size, self.params = size, params
        self.n_train, self.n_types, self.end_count = n_train, n_types, end_count
        self.norm = float(n_train + 0.5 * (n_types + 1))
        self.base = np.log10((self.counts + 0.5) / self.norm)
        self.end = math.log10((end_count + 0.5) / self.norm)
        if mass is None:
            listed = (10.0 ** self.base[:size]).sum() + 10.0 ** self.end
            mass = np.array([max((1.0 - float(listed)) * self.norm, 0.5)])
        self.rest, self.classes = np.log10(mass / self.norm), len(mass)
        self.z = normalisers(params)

    def open(self) -> Model:
        self.ids = {w: i for i, w in enumerate(self.words)}
        self.h = self.params["r"] * self.params["c"]
        return self

    def neural(self, path: np.ndarray) -> float:
        """log10 probability of a path of classes, the first one given."""
        found = 0.0
        for i in range(0, len(path) - 1, SLICE):
            h, w = path[i:i + SLICE + 1][:-1], path[i + 1:i + 1 + SLICE]
            found += np.einsum("ij,ij->", self.h[h], self.params["q"][w]) + (self.params["b"][w] - self.z[h]).sum()
        return found / math.log(10)


_MODELS: dict = {}


def train_model(train: DataFrame, vocab: int | None, growth: float, head: int, steps: int = 480, **options) -> tuple[Model, DataFrame]:
    """The model, and the table of all word counts."""
    counts = stage(word_counts(train), "word-counts")
    total = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n_docs = train.count()
    listed = frequent(counts, head)
    wanted = vocab if vocab is not None else math.ceil(growth * total.v ** (1 / 3))
    size, classes = min(wanted, len(listed)), max(1, wanted // 2)
    width = size + classes + 1
    ids = {w.encode(): i for i, (w, _) in enumerate(listed[:size])}
    found = pair_counts(train, ids, size, classes).toArrow()
    cell, n = found.column("pair").to_numpy(), found.column("n").to_numpy()
    dev = cell >= width * width
    # as many steps as serve texts that were not learnt from, then all of them
    _, best = fit(Pairs(width, cell[~dev], n[~dev]), Pairs(width, cell[dev] - width * width, n[dev]), steps=steps, **options)
    params, _ = fit(Pairs(width, cell % (width * width), n), steps=best, **options)
    mass = class_counts(counts, listed[:size], classes)
    return Model(listed, size, params, (total.n or 0) + n_docs, total.v + (1 if n_docs else 0), n_docs, mass), counts


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab: int | None = None, growth: float = 12.0,
          head: int = 200_000, is_held_out=held_out, **options) -> DataFrame:
    """One row per document; see the contract's columns."""
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("t"), is_held_out(docs[id_col]).alias("out"),
                      (F.pmod(text_key(docs[text_col]), F.lit(5)) == 0).alias("dev"))
    id_type = src.schema["id"].dataType.simpleString()
    model, counts = train_model(src.where("not out"), vocab, growth, head, **options)
    sent, name_of = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex
    size, classes = model.size, model.classes
    tail_type = pa.list_(pa.struct([("w", pa.string()), ("n", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _MODELS.get(name_of)
        if m is None:
            _MODELS.clear()
            m = _MODELS[name_of] = sent.value.open()
        row, none, edge = TaskContext.get().partitionId() << 33, len(m.words), size + classes
        for b in batches:
            cols: list[list] = [[] for _ in range(6)]
            for t in b.column("t").to_pylist():
                words = words_of(t)
                found = [m.ids.get(w, none) for w in words]
                path = np.array([edge, *(i if i < size else size + class_of(w, classes) for w, i in zip(words, found)), edge])
                i = np.array(found, np.int64)
                known, other = i[i < none], path[(path >= size) & (path < edge)]
                # words of no class of their own: their share of it, here for those whose count is at hand
                neural = m.neural(path) + m.base[known[known >= size]].sum() - m.rest[other - size].sum()
                tail = Counter(w for w, k in zip(words, found) if k == none) if len(known) < len(words) else {}
                for c, v in zip(cols, (row, len(words) + 1, len(known) + (m.end_count > 0), m.base[known].sum() + m.end,
                                       neural, [{"w": w, "n": n} for w, n in tail.items()])):
                    c.append(v)
                row += 1
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("out"), *(pa.array(c, k) for c, k in zip(
                    cols, (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), tail_type)))],
                names=["id", "out", "row", "n", "known", "base", "neural", "tail"])

    rows = stage(src.drop("dev").mapInArrow(run, f"id {id_type}, out boolean, row bigint, n bigint, known bigint, base double, "
                                     "neural double, tail array<struct<w:string,n:bigint>>"), "lm-rows")
    tail = rows.select("row", F.explode("tail").alias("x")).select("row", "x.w", F.col("x.n").alias("k")).join(
        counts, "w", "left")
    share = F.col("k") * F.log10((F.coalesce("n", F.lit(0)) + 0.5) / F.lit(model.norm))
    sums = tail.groupBy("row").agg(F.sum(share).alias("tail_base"),
                                   F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(0)).alias("tail_known"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return rows.drop("tail").join(sums, "row", "left").select(
        F.col("id").alias(id_col), F.col("out").alias("held_out"), F.col("n").alias("n_tokens"),
        (F.col("known") + zero("tail_known")).alias("n_known"), F.lit(model.n_train).cast("long").alias("train_tokens"),
        (F.col("base") + zero("tail_base")).alias("base_score"),
        (F.col("neural") + zero("tail_base")).alias("score"))

