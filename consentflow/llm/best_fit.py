"""Packing of tokenised documents by best-fit decreasing (operator 13).

Documents are encoded and cut into full windows of ``capacity`` ids and a rest.
Pieces are placed longest first, each in the *tightest* open window: the one
whose remaining capacity is the least that suffices. A segment tree over the
remaining capacities finds it.

Which pieces of one length go where does not matter, so the placing works on
the *number of pieces of each length* -- ``capacity`` counts, whatever the size
of the corpus -- and moves whole groups of windows alike. It gives *rules*: the
pieces g to g' (in order of falling length) go, q to a window, into the windows
from w on, behind the first b ids. The corpus-wide number of a piece comes from
counts by task and length and their running sums; every piece then finds its
rule by binary search. Full windows are sequences as they stand and stay where
they are; rests move by sequence once they are placed. No piece passes the driver, nothing is capped, and no
length, however frequent, meets in one task.

Windows that stay open with more than ``max_gap`` ids to go are laid end to end
and cut every ``capacity`` ids (one cut a window at most); the end of that run
is cut at powers of two, which need no padding. So a sequence is full, lacks
``max_gap`` ids at most, or has a power of two of ids.

Bounds: the driver and the tasks hold the counts, the groups of windows (two
more a length) and the rules (one for each length and group it meets, some
thousand in practice). A sequence has at most ``capacity`` pieces.

Defined cases: null and empty texts hold the end id alone; a null id is kept;
repeated rows are packed each; very long texts are cut into windows as they are
encoded; ties (windows equally tight) go to the group that opened first; an
empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from consentflow.llm.common import stage
from consentflow.llm.token_output import UnitEncoder, larger_batches

CAPACITY = 1024
END_ID = 0
MAX_GAP = 4
BATCH = 1 << 24  # bytes of text that are encoded in one go


class CapacityTree:
    """Segment tree over remaining capacities 0..capacity: which are open."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.size)
        self.groups: dict[int, deque] = {}

    def _mark(self, capacity: int, state: bool) -> None:
        i = capacity + self.size
        self.open[i] = state
        while i > 1:
            i >>= 1
            self.open[i] = self.open[2 * i] or self.open[2 * i + 1]

    def push(self, capacity: int, windows: tuple[int, int]) -> None:
        self.groups.setdefault(capacity, deque()).append(windows)
        if not self.open[capacity + self.size]:
            self._mark(capacity, True)

    def pop(self, capacity: int) -> tuple[int, int]:
        held = self.groups[capacity]
        windows = held.popleft()
        if not held:
            self._mark(capacity, False)
        return windows

    def tightest(self, least: int) -> int | None:
        """The least open capacity of at least ``least``."""
        i = least + self.size
        if i >= 2 * self.size:
            return None
        while not self.open[i]:
            while i & 1:  # a right child: nothing further under its parent
                i >>= 1
            if i == 0:
                return None
            i += 1  # the next subtree to the right
            if i & (i - 1) == 0:  # past the last one of its level
                return None
        while i < self.size:
            i = 2 * i if self.open[2 * i] else 2 * i + 1
        return i - self.size


class Plan:
    """Where the pieces go, from the number of pieces of each length."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY, max_gap: int = MAX_GAP):
        self.capacity = capacity
        tree, rules, windows, at = CapacityTree(capacity), [], 0, 0
        self.first = np.zeros(capacity + 1, np.int64)  # the number of a length's first piece
        for length in sorted(counts, reverse=True):
            left = counts[length]
            self.first[length] = at
            while left:
                room = tree.tightest(length)
                if room is None:
                    room, held = capacity, (windows, -(-left // (capacity // length)))
                    windows += held[1]
                else:
                    held = tree.pop(room)
                start, n = held
                each = room // length
                full = min(n, left // each)
                if full:  # the next piece finds the window just used the tightest as long as it suffices
                    rules.append((at, start, each, capacity - room))
                    tree.push(room - each * length, (start, full))
                    at, left, start, n = at + full * each, left - full * each, start + full, n - full
                if n and left and left < each:
                    rules.append((at, start, left, capacity - room))
                    tree.push(room - left * length, (start, 1))
                    at, left, start, n = at + left, 0, start + 1, n - 1
                if n:
                    tree.push(room, (start, n))
        self.rules = np.array(rules, np.int64).reshape(-1, 4)
        groups = sorted((start, n, capacity - room) for room, held in tree.groups.items() for start, n in held)
        # groups of windows: first window, used ids, kept as they are, then the first
        # sequence (if kept) or the first id of the run that is cut anew
        self.groups = np.zeros((len(groups), 4), np.int64)
        run = kept = 0
        for i, (start, n, used) in enumerate(groups):
            keeps = capacity - used <= max_gap or used & (used - 1) == 0
            self.groups[i] = start, used, keeps, kept if keeps else run
            kept, run = kept + n * keeps, run + n * used * (not keeps)
        self.kept, self.run = kept, run
        cuts, end = [], run // capacity * capacity
        rest = run - end
        if rest and capacity - rest > max_gap:
            while rest:
                part = 1 << rest.bit_length() - 1
                end, rest = end + part, rest - part
                cuts.append(end)
        self.tail = run // capacity * capacity
        self.cuts = cuts[:-1]  # ends inside the last, open stretch

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For pieces (length, number within the length): whether the window is
        kept, its sequence or else the piece's first id in the run, the offset."""
        at = self.first[length] + number
        start, first, each, base = self.rules[np.searchsorted(self.rules[:, 0], at, "right") - 1].T
        window, offset = first + (at - start) // each, base + (at - start) % each * length
        w, used, keeps, to = self.groups[np.searchsorted(self.groups[:, 0], window, "right") - 1].T
        keeps = keeps.astype(bool)
        return keeps, np.where(keeps, to + window - w, to + (window - w) * used + offset), offset

    def cut(self, start: int, length: int) -> list[tuple[int, int, int, int]]:
        """(sequence, offset, from, to) of the parts of a piece of the run."""
        end, out, at = start + length, [], start
        ends = [*range(start // self.capacity * self.capacity + self.capacity, min(end, self.tail + 1), self.capacity),
                *[c for c in self.cuts if start < c < end], end]
        for e in ends:
            if e > at:
                if at < self.tail:
                    sequence, offset = at // self.capacity, at % self.capacity
                else:
                    before = [c for c in self.cuts if c <= at]
                    sequence = self.tail // self.capacity + len(before)
                    offset = at - (before[-1] if before else self.tail)
                out.append((self.kept + sequence, offset, at - start, e - start))
                at = e
        return out


@lru_cache(maxsize=1)
def _encoder(path: str) -> UnitEncoder:
    return UnitEncoder(path)


PIECE = "start bigint, length int, doc_tokens bigint, ids binary"


def _piece_arrays(rows: list[tuple]) -> list[pa.Array]:
    start, length, tokens, ids = zip(*rows) if rows else ((),) * 4
    return [pa.array(start, pa.int64()), pa.array(length, pa.int32()), pa.array(tokens, pa.int64()), pa.array(ids, pa.binary())]


def cut_documents(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, capacity: int = CAPACITY,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Full windows and rests of all documents, each with its number among the
    pieces of its length in its task. Ids are little-endian; their width follows
    from the length of ``ids``."""
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("t"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, enc = TaskContext.get().partitionId(), _encoder(tokenizer_path)
        width = enc.width if end_id < 1 << 8 * enc.width else 4
        tail, seen = end_id.to_bytes(width, "little"), [0] * (capacity + 1)
        for b in larger_batches(batches, BATCH):
            rows, owner, number = [], [], []
            for i, ids in enumerate(enc.encode(b.column("t"))):
                if width != enc.width:
                    ids = np.frombuffer(ids, enc.kind).astype("<u4").tobytes()
                ids += tail
                n = len(ids) // width
                for s in range(0, n, capacity):
                    size = min(capacity, n - s)
                    rows.append((s, size, n, ids[s * width:(s + size) * width]))
                    owner.append(i)
                    number.append(seen[size])
                    seen[size] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([task] * len(rows), pa.int32()), pa.array(number, pa.int64()),
                 b.column("id").take(pa.array(owner, pa.int64())), *_piece_arrays(rows)],
                names=["task", "number", "id", "start", "length", "doc_tokens", "ids"])

    return src.mapInArrow(run, f"task int, number bigint, id {kind}, {PIECE}")


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY, max_gap: int = MAX_GAP) -> tuple[DataFrame, int]:
    """``pieces`` (of ``cut_documents``, staged) with sequence and offset, cut
    where their window is; and the number of sequences."""
    counts = pieces.groupBy("task", "length").count()
    total = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}  # ``capacity`` at most
    plan = Plan(total, capacity, max_gap)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("task", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    numbered = pieces.join(bases, ["task", "length"]).select(
        "id", "start", "length", "doc_tokens", "ids", (F.col("base") + F.col("number")).alias("number"))
    kind = pieces.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length = b.column("length").to_numpy()
            keeps, to, offset = plan.place(length.astype(np.int64), b.column("number").to_numpy())
            held = b.filter(pa.array(keeps))
            yield pa.RecordBatch.from_arrays(
                [pa.array(to[keeps]), pa.array(offset[keeps].astype(np.int32)), *[held.column(c) for c in ("id", "start", "length", "doc_tokens", "ids")]],
                names=["sequence_id", "offset", "id", "start", "length", "doc_tokens", "ids"])
            moved = b.filter(pa.array(~keeps))
            rows, owner, sequence, offsets = [], [], [], []
            for i, (first, s, n, tokens, ids) in enumerate(zip(to[~keeps].tolist(), *[
                    moved.column(c).to_pylist() for c in ("start", "length", "doc_tokens", "ids")])):
                width = len(ids) // n
                for seq, off, x, y in plan.cut(first, n):
                    rows.append((s + x, y - x, tokens, ids[x * width:y * width]))
                    owner.append(i)
                    sequence.append(seq)
                    offsets.append(off)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sequence, pa.int64()), pa.array(offsets, pa.int32()), moved.column("id").take(pa.array(owner, pa.int64())), *_piece_arrays(rows)],
                names=["sequence_id", "offset", "id", "start", "length", "doc_tokens", "ids"])

    placed = numbered.mapInArrow(run, f"sequence_id bigint, offset int, id {kind}, {PIECE}")
    return placed, plan.kept + plan.tail // capacity + len(plan.cuts) + 1


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, capacity: int = CAPACITY, max_gap: int = MAX_GAP,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per sequence: ``sequence_id``, its ``pieces`` in order (offset,
    id, start in the document, length, tokens of the document, ids)."""
    pieces = stage(cut_documents(docs, tokenizer_path, end_id, capacity, id_col, text_col), "pieces")
    cols = ["offset", "id", "start", "length", "doc_tokens", "ids"]
    placed, used = place_pieces(pieces.where(F.col("length") < capacity), capacity, max_gap)
    packed = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct(*cols))).alias("pieces"))
    # a full window is a sequence as it stands; the numbers behind those used are free
    number = F.lit(used) + F.shiftleft(F.col("task").cast("long"), 40) + F.col("number")
    full = pieces.where(F.col("length") == capacity).select(
        number.alias("sequence_id"), F.array(F.struct(F.lit(0).alias("offset"), *cols[1:])).alias("pieces"))
    return packed.unionByName(full)


def digest(sequences: DataFrame) -> DataFrame:
    """Per piece: its place and the crc32 of its ids as 32-bit integers."""
    rows = sequences.select("sequence_id", F.explode("pieces").alias("p")).select(
        F.col("p.id").alias("doc_id"), "p.start", F.col("p.length").cast("long").alias("length"), "p.ids",
        "p.doc_tokens", "sequence_id", F.col("p.offset").cast("long").alias("offset"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            crc = [zlib.crc32(np.frombuffer(x, f"<u{len(x) // n}").astype("<u4"))
                   for x, n in zip(b.column("ids").to_pylist(), b.column("length").to_pylist())]
            yield b.set_column(3, "ids_crc32", pa.array(crc, pa.int64()))

    return rows.mapInArrow(run, f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
                                "sequence_id bigint, offset bigint")
