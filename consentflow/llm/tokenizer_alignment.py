"""Alignment of two tokenizers' ids over the same bytes (operator 12).

A document's text, with one space in front, is encoded by A (byte-level BPE of
the ``tokenizers`` library) and by B (a ``sentencepiece`` model, which adds the
space itself); in both, the strings of special tokens are plain text. The places
where tokens of both end cut the ids into *groups*; tokens that end together are
*linked*. Of every link the corpus-wide number of links of its two ids is wanted.

1. *Identity map.* For each id of A the id of B with the same bytes is computed
   beforehand. Most groups are one A id with its B id: such a group is named by
   the A id alone, two bytes, and counted in a vector as long as A's vocabulary,
   one for each task; tasks' vectors add up.
2. Only the other, irregular groups' links are counted as pairs (added up in the
   tasks, then shuffled by pair).
3. Every document sums its links' counts: identity links by look-up in A-long
   vectors; irregular pairs that make up more than 1 / ``HEAVY`` of all irregular
   links likewise (there are ``HEAVY`` at most, so their table is bounded, and
   what remains has no hot key); the remaining pairs, once a document each, are
   joined with the counts by pair and summed by document.

Texts are cut into units at single spaces between two non-blank characters. A
starts a new token there; so does B if none of its pieces has a space behind
another character, which is checked (else texts stay whole). A worker encodes
and aligns each distinct unit once. A document one of whose units comes out with
other bytes in A or B is encoded and compared again as a whole.

Defined cases: null and empty texts, and texts whose joined bytes of A or B are
not the space and the text, have no tokens: zeros and ''; a null id is kept;
repeated rows count each; very long texts and units are aligned like others, in
memory linear in one text; ties for a B id's highest count are all best; an
empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from consentflow.llm.common import stage
from consentflow.llm.token_output import UnitEncoder, put_together, slices_of, split_units

STORE_UNITS = 250_000  # a generation; two are held
STORED_CHARS = 200  # longer units are aligned each time they come
BLOCK = 1 << 14
HEAVY = 1 << 16
SPACE = "▁"


def byte_alphabet() -> dict[str, int]:
    """Byte of each character of byte-level vocabularies: printable bytes stand
    for themselves, the others for the characters from 256 on, in order."""
    same = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in same]
    return {chr(b): b for b in same} | {chr(256 + i): b for i, b in enumerate(other)}


class Aligner:
    """Both tokenizers, their tokens' bytes and the identity map."""

    def __init__(self, a_path: str, b_path: str, limit: int = STORE_UNITS):
        import sentencepiece

        self.a = UnitEncoder(a_path, limit=1, plain_special=True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        alphabet = byte_alphabet()
        vocab = self.a.tok.get_vocab()
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            # a special token's string is no byte-level text; it is never produced
            self.a_bytes[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        size = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(size)]
        self.b_bytes = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        made = {}
        for i in range(size - 1, -1, -1):  # the first id of equal bytes, a piece before a byte id
            if not (self.b.is_control(i) or self.b.is_unknown(i)) and not (self.b.is_byte(i) and self.b_bytes[i] in made):
                made[self.b_bytes[i]] = i
        self.same = np.array([made.get(x, -1) for x in self.a_bytes], np.int64)
        self.cuts = not any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.wide = "<u2" if len(self.a_bytes) <= 1 << 16 else "<u4"
        self.a_size, self.b_size = (np.array([len(x) for x in xs], np.int64) for xs in (self.a_bytes, self.b_bytes))
        # an id as it is said inside a group, and as its last one
        self.said = pa.array([f"{i}{end}".encode() for ends, n in ((",|", len(self.a_bytes)), (",;", size)) for i in range(n) for end in ends],
                             pa.large_binary())
        self.limit = limit
        self.known: dict[str, tuple] = {}
        self.older: dict[str, tuple] = {}

    def align(self, texts: list[str], a: list[np.ndarray], b: list[list[int]]) -> list[tuple | None]:
        """For every text, (ids of A, ids of B, groups, links, text of the
        groups, identity ids, pairs of the other links), or None if the bytes of
        either differ from the space and the text. All texts at once: laid end
        to end, each one's end is a place where both end."""
        data = [b" " + t.encode() for t in texts]
        good = [b"".join([self.a_bytes[i] for i in x.tolist()]) == d == b"".join([self.b_bytes[i] for i in y])
                for x, y, d in zip(a, b, data)]
        out: list[tuple | None] = [None] * len(texts)
        if not any(good):
            return out
        a, b, data = ([x for x, g in zip(xs, good) if g] for xs in (a, b, data))
        n_a, n_b = np.array([len(x) for x in a]), np.array([len(y) for y in b])
        ids_a, ids_b = np.concatenate(a).astype(np.int64), np.fromiter(chain.from_iterable(b), np.int64, int(n_b.sum()))
        ends_a, ends_b = np.cumsum(self.a_size[ids_a]), np.cumsum(self.b_size[ids_b])
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        last_a, last_b = np.searchsorted(ends_a, cuts), np.searchsorted(ends_b, cuts)
        first_a, first_b = np.append(0, last_a[:-1] + 1), np.append(0, last_b[:-1] + 1)
        same = (first_a == last_a) & (first_b == last_b) & (self.same[ids_a[last_a]] == ids_b[last_b])
        ident = ids_a[last_a[same]].astype(self.wide).tobytes()
        pairs = (ids_a[last_a] << 32 | ids_b[last_b])[~same].astype("<u8").tobytes()
        # groups, and those of one kind, up to the end of each text
        upto = np.append(0, np.searchsorted(cuts, np.cumsum([len(d) for d in data]), "right"))
        of_same = np.append(0, np.cumsum(same))[upto]
        # the ids of a group follow each other, those of A first
        size_a, size_b = last_a - first_a + 1, last_b - first_b + 1
        place = np.empty(len(ids_a) + len(ids_b), np.int64)
        said_a, said_b = 2 * ids_a, 2 * ids_b + 2 * len(self.a_bytes)
        said_a[last_a] += 1
        said_b[last_b] += 1
        place[np.arange(len(ids_a)) + np.repeat(first_b, size_a)] = said_a
        place[np.arange(len(ids_b)) + np.repeat(last_a + 1, size_b)] = said_b
        said = slices_of(self.said, place, np.append(0, np.cumsum(n_a + n_b)))
        width, groups = np.dtype(self.wide).itemsize, np.diff(upto).tolist()
        i, p = (width * of_same).tolist(), (8 * (upto - of_same)).tolist()
        made = iter(zip(n_a.tolist(), n_b.tolist(), groups, groups, said,
                        [ident[x:y] for x, y in zip(i, i[1:])], [pairs[x:y] for x, y in zip(p, p[1:])]))
        return [next(made) if g else None for g in good]

    def _both(self, texts: list[str]) -> list[tuple | None]:
        """Alignments of texts that are not stored; each gets a space in front."""
        a = [np.frombuffer(x, self.a.kind) for x in self.a._encode_units(texts)]
        return self.align(texts, a, self.b.encode(texts, num_threads=1))

    def whole(self, text: str) -> tuple | None:
        """One text, not cut."""
        ids = np.array(self.a.tok.encode(" " + text, add_special_tokens=False).ids)
        return self.align([text], [ids], [self.b.encode(text, num_threads=1)])[0]

    def _lookup(self, found: list[str]) -> list[tuple | None]:
        if len(self.known) > self.limit:
            self.known, self.older = {}, self.known
        known, older, got = self.known, self.older, {}
        new = []
        for u in found:
            if u in known:
                got[u] = known[u]
            elif u in older:
                got[u] = known[u] = older[u]
            else:
                new.append(u)
        for at in range(0, len(new), BLOCK):
            part = new[at:at + BLOCK]
            for u, x in zip(part, self._both(part)):
                got[u] = x
                if len(u) <= STORED_CHARS:
                    known[u] = x
        return [got[u] for u in found]

    def texts(self, texts: pa.Array) -> list[tuple | None]:
        """Alignment of every text; None for null, empty and differing ones."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if self.cuts:
            offsets, words = split_units(texts)
        else:
            offsets, words = np.arange(len(texts) + 1), texts
        coded = words.dictionary_encode()
        place = coded.indices.to_numpy()
        found = self._lookup(coded.dictionary.to_pylist())
        bad = np.array([x is None for x in found] + [False])
        none = (0, 0, 0, 0, b"", b"", b"")
        found = [x or none for x in found]
        sums = np.array([x[:4] for x in found], np.int64).reshape(-1, 4)[place]
        upto = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(sums, axis=0)])
        numbers = (upto[offsets[1:]] - upto[offsets[:-1]]).tolist()
        said, ident, pairs = (put_together([x[k] for x in found], place, offsets) for k in (4, 5, 6))
        wrong = np.concatenate([[0], np.cumsum(bad[place])])
        again = wrong[offsets[1:]] > wrong[offsets[:-1]]
        out = []
        empty = pc.equal(pc.binary_length(texts), 0).to_pylist()
        for i in range(len(texts)):
            if empty[i]:
                out.append(None)
            elif again[i]:
                out.append(self.whole(texts[i].as_py()))
            else:
                out.append((*numbers[i], said[i], ident[i], pairs[i]))
        return out


@lru_cache(maxsize=1)
def _aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


ALIGNED = "row bigint, id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, ident binary, pairs binary"


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
          hashed: bool = False) -> DataFrame:
    """One row per document: a row number, the id, sizes, ``groups`` as text
    (``a1,a2|b1;...``; with ``hashed`` its sha256 instead), A ids of the identity
    links, and the other links (A id times 2^32 plus B id, 64 bits each).

    The row number holds the task and counts in it: fixed once written."""
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("t"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, row = _aligner(a_path, b_path), TaskContext.get().partitionId() << 33
        for b in batches:
            found = [x or (0, 0, 0, 0, b"", b"", b"") for x in aligner.texts(b.column("t"))]
            said = [x[4][:-1] for x in found]
            if hashed:
                said = [hashlib.sha256(x).hexdigest() if x else "" for x in said]
            cols = [pa.array([x[k] for x in found], pa.int64()) for k in range(4)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + len(found))), b.column("id"), *cols,
                 pa.array(said, pa.string()), *[pa.array([x[k] for x in found], pa.binary()) for k in (5, 6)]],
                names=["row", "id", "n_a", "n_b", "n_groups", "n_links", "groups", "ident", "pairs"])
            row += len(found)

    return src.mapInArrow(run, ALIGNED.format(kind=kind))


def _codes(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column, and the offsets of its rows' values."""
    parts = column.to_pylist()
    size = np.dtype(kind).itemsize
    return np.frombuffer(b"".join(parts), kind), np.concatenate([[0], np.cumsum([len(x) // size for x in parts])]).astype(np.int64)


def link_counts(aligned: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``pair``, ``b``, ``n`` and ``ident``: how many links have the two ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(a_path, b_path)
        vector = np.zeros(len(aligner.a_bytes), np.int64)
        for b in batches:
            ids, _ = _codes(b.column("ident"), aligner.wide)
            vector += np.bincount(ids, minlength=len(vector))
            pairs, n = np.unique(_codes(b.column("pairs"), "<u8")[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pairs.astype(np.int64)), pa.array(n.astype(np.int64)), pa.array([False] * len(n))],
                                             names=["pair", "n", "ident"])
        a = np.flatnonzero(vector)
        yield pa.RecordBatch.from_arrays([pa.array(a << 32 | aligner.same[a]), pa.array(vector[a]), pa.array([True] * len(a))],
                                         names=["pair", "n", "ident"])

    found = aligned.select("ident", "pairs").mapInArrow(run, "pair bigint, n bigint, ident boolean")
    return found.groupBy("pair", "ident").agg(F.sum("n").alias("n")).select(
        "pair", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("b"), "n", "ident")


def _ranked(counts: DataFrame) -> DataFrame:
    """``counts`` with ``best``: no pair of the B id has a higher count."""
    top = counts.groupBy("b").agg(F.max("n").alias("top"))
    return counts.join(top, "b").select("pair", "n", "ident", (F.col("n") == F.col("top")).alias("best"))


def link_sums(aligned: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per document of ``aligned`` (staged): ``n_best`` and ``count_sum`` beside
    its row number, id, sizes and groups."""
    counts = stage(_ranked(link_counts(aligned, a_path, b_path)), "link-counts")
    odd = counts.where(~F.col("ident"))
    total = odd.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    heavy = F.col("n") * HEAVY > total
    sc = aligned.sparkSession.sparkContext
    # bounded: an identity pair for each id of A, HEAVY irregular pairs
    kept = counts.where(F.col("ident") | heavy).orderBy("pair").toArrow()
    pair, n, best, ident = (kept.column(c).to_numpy() for c in ("pair", "n", "best", "ident"))
    size = len(_aligner(a_path, b_path).a_bytes)
    of_a, best_a = np.zeros(size, np.int64), np.zeros(size, bool)
    of_a[pair[ident] >> 32], best_a[pair[ident] >> 32] = n[ident], best[ident]
    # a last entry that no pair equals, so that every search has a place
    none = np.array([np.iinfo(np.int64).max])
    table = sc.broadcast((of_a, best_a, np.append(pair[~ident], none), np.append(n[~ident], 0), np.append(best[~ident], False)))

    def sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
        upto = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return upto[ends[1:]] - upto[ends[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_a, best_a, pair, n, best = table.value
        wide = "<u2" if len(of_a) <= 1 << 16 else "<u4"
        for b in batches:
            ids, ends = _codes(b.column("ident"), wide)
            odd, odd_ends = _codes(b.column("pairs"), "<u8")
            odd = odd.astype(np.int64)
            place = np.searchsorted(pair, odd)
            hit = pair[place] == odd
            total = sums(of_a[ids], ends) + sums(np.where(hit, n[place], 0), odd_ends)
            bests = sums(best_a[ids], ends) + sums(hit & best[place], odd_ends)
            light = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(sums(~hit, odd_ends))]).astype(np.int32)), pa.array(odd[~hit]))
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in ("row", "id", "n_a", "n_b", "n_groups", "n_links", "groups")],
                 pa.array(bests), pa.array(total), light],
                names=["row", "id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum", "light"])

    kind = aligned.schema["id"].dataType.simpleString()
    part = aligned.mapInArrow(run, f"row bigint, id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
                                   "groups string, n_best bigint, count_sum bigint, light array<bigint>")
    # a document's remaining pairs, once each; none of them is frequent
    light = part.select("row", F.explode("light").alias("pair")).groupBy("row", "pair").agg(F.count(F.lit(1)).alias("times"))
    rest = light.join(odd.select("pair", "n", "best"), "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    return part.drop("light").join(rest, "row", "left").select(
        "row", "id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups")


def digest(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Sizes, sums of the links' counts and the groups' sha256 of each document."""
    aligned = stage(align(docs, a_path, b_path, hashed=True), "aligned")
    return link_sums(aligned, a_path, b_path).select(
        F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
        F.col("groups").alias("groups_sha256"))
