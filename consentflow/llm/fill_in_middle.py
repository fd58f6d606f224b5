"""Fill-in-the-middle transformation by content-defined chunks (operator 11).

A text is cut into prefix, middle and suffix at two units (code points) that its
id's hash draws. How many units a text has, and where the k-th one starts, comes
from *chunks*:

* A rolling hash over the last 32 bytes names the chunk ends, so equal passages
  fall into equal chunks wherever they stand. Chunks have ``LEAST`` to ``MOST``
  bytes.
* A worker keeps a summary of each distinct chunk: its number of units, whether
  it holds a sentinel, and its first and last bytes, because a sentinel may lie
  across a border. The store is asked by a 64-bit fingerprint and the found
  entry's content is compared before its summary is used.
* Summaries combine: counts add up, and of two neighbours the last bytes of the
  one and the first of the other are searched for sentinels. The running sum of
  the counts names the chunk that holds a cut; only this chunk is looked into.

The store holds ``STORE_BYTES`` of chunks in two generations; the older one goes
when the younger is full, which changes the time taken and nothing else.

Defined cases: a null text counts as empty; an empty text, or one that holds a
sentinel, is left plain; a null id is drawn like the empty string; rows that
repeat an id are cut by the same draws; very long texts are cut like others, in
memory linear in one text; ties of the two draws give an empty middle; an empty
table gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINELS = tuple(x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
REACH = max(map(len, SENTINELS)) - 1  # bytes of a sentinel that can lie on one side of a border
SEED = 1
PLAIN_FROM = 90  # of 100 draws, these and above stay plain
SPM_BELOW = 20  # of 100 draws, those below put the suffix first
LEAST, MOST = 256, 8192
MASK = np.uint32(0x3FF << 16)  # a chunk end about every 1,024 bytes beyond the least
BLOCK = 1 << 22
WINDOW = 32
STORE_BYTES = 48 << 20


@lru_cache(maxsize=1)
def _gear() -> np.ndarray:
    """32 random bits for each byte value, from a hash."""
    return np.array([int.from_bytes(hashlib.sha256(bytes([i])).digest()[:4], "little") for i in range(256)], np.uint32)


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """At each byte, the sum of the last 32 bytes' random bits, the j-th last one
    shifted left by j (32 bits: older bytes fall out). By doubling windows."""
    h = _gear()[data]
    size = 1
    while size < WINDOW:
        h[size:] += h[:-size] << np.uint32(size)
        size *= 2
    return h


def marks_of(data: np.ndarray) -> np.ndarray:
    """Ends that the hash names, block by block so that memory stays small."""
    found = []
    for at in range(0, len(data), BLOCK):
        before = min(at, WINDOW - 1)
        h = rolling_hash(data[at - before:at + BLOCK])[before:]
        found.append(np.flatnonzero(h & MASK == 0) + at + 1)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def chunk_ends(marks: list[int], start: int, end: int) -> list[int]:
    """Ends of the chunks of bytes [start, end); ``marks`` are the hash's ends
    in it, ascending."""
    out, last = [], start
    for m in [*marks, end]:
        while m - last > MOST:
            last += MOST
            out.append(last)
        if m - last >= LEAST and m < end:
            last = m
            out.append(m)
    if last < end:
        out.append(end)
    return out


def has_sentinel(data: bytes) -> bool:
    return any(s in data for s in SENTINELS)


def starts_of_units(chunk: bytes) -> np.ndarray:
    """Where the chunk's code points start: bytes that continue none."""
    return np.flatnonzero(np.frombuffer(chunk, np.uint8) & 0xC0 != 0x80)


class ChunkStore:
    """Summaries (units, sentinel inside, first bytes, last bytes) by content."""

    def __init__(self, limit: int = STORE_BYTES):
        self.limit, self.held = limit, 0
        self.known: dict[int, tuple] = {}
        self.older: dict[int, tuple] = {}
        self.asked = self.found = self.refused = 0

    def _keep(self, name: int, entry: tuple) -> None:
        if self.held >= self.limit:
            self.known, self.older, self.held = {}, self.known, 0
        self.known[name] = entry
        self.held += len(entry[0]) + 200

    def summary(self, chunk: bytes) -> tuple:
        name = hash(chunk)  # 64 bits
        self.asked += 1
        entry = self.known.get(name)
        if entry is None and (entry := self.older.get(name)) is not None:
            self._keep(name, entry)
        if entry is not None:
            if entry[0] == chunk:
                self.found += 1
                return entry[1]
            self.refused += 1  # another chunk of this fingerprint
        out = (len(starts_of_units(chunk)), has_sentinel(chunk), chunk[:REACH], chunk[-REACH:])
        self._keep(name, (chunk, out))
        return out


@lru_cache(maxsize=1)
def _store() -> ChunkStore:
    return ChunkStore()


class ChunkedText:
    """A text as chunks: number of units, sentinels, byte of a unit."""

    def __init__(self, data: bytes, ends: list[int], store: ChunkStore):
        """``ends`` are byte ends within ``data``."""
        self.data, self.starts = data, [0, *ends[:-1]]
        counts, self.sentinel, before = [], False, b""
        for a, b in zip(self.starts, ends):
            n, inside, first, last = store.summary(data[a:b])
            counts.append(n)
            self.sentinel = self.sentinel or inside or has_sentinel(before + first)
            before = (before + last)[-REACH:] if b - a < REACH else last
        self.upto = np.cumsum(counts) if counts else np.zeros(0, np.int64)
        self.ends = ends
        self.units = int(self.upto[-1]) if counts else 0

    def byte_of(self, unit: int) -> int:
        """The byte at which a unit starts (the end, for the number of units)."""
        if unit >= self.units:
            return len(self.data)
        c = int(np.searchsorted(self.upto, unit, "right"))
        inside = unit - (int(self.upto[c - 1]) if c else 0)
        return self.starts[c] + int(starts_of_units(self.data[self.starts[c]:self.ends[c]])[inside])


def draws(doc_id, seed: int = SEED) -> tuple[int, int, int, int]:
    text = f"{seed}:{'' if doc_id is None else doc_id}"
    digest = hashlib.sha256(text.encode()).hexdigest()
    return tuple(int(digest[8 * i:8 * i + 8], 16) for i in range(4))


def transform_text(text: ChunkedText, doc_id) -> tuple[str, int | None, int | None, bytes]:
    """Form, code points of prefix and of middle, output."""
    h1, h2, h3, h4 = draws(doc_id)
    if text.units == 0 or text.sentinel or h3 % 100 >= PLAIN_FROM:
        return "plain", None, None, text.data
    a, b = sorted((h1 % (text.units + 1), h2 % (text.units + 1)))
    x, y = text.byte_of(a), text.byte_of(b)
    p, s, m = SENTINELS
    prefix, middle, suffix = text.data[:x], text.data[x:y], text.data[y:]
    if h4 % 100 < SPM_BELOW:
        return "spm", a, b - a, s + suffix + p + prefix + m + middle
    return "psm", a, b - a, p + prefix + s + suffix + m + middle


def _batch(texts: pa.Array, store: ChunkStore) -> Iterator[ChunkedText]:
    """All texts of a batch; one rolling hash runs over their common buffer. A
    window that reaches into the text before ends no chunk: chunks, and the
    first of a text too, have more bytes than the window."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    lo, hi = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(texts.buffers()[2], np.uint8, hi - lo, lo) if hi > lo else np.zeros(0, np.uint8)
    marks = marks_of(data)
    at = offsets - lo
    bounds = np.searchsorted(marks, at, "right").tolist()
    raw, at, marks = data.tobytes(), at.tolist(), marks.tolist()
    for i in range(len(texts)):
        a, b = at[i], at[i + 1]
        ends = chunk_ends(marks[bounds[i]:bounds[i + 1]], a, b)
        yield ChunkedText(raw[a:b], [e - a for e in ends], store)


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n`` code points, ``form`` (plain, psm, spm),
    ``prefix_chars``, ``middle_chars`` (null if plain) and the ``output`` text."""
    src = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("t"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = _store()
        for batch in batches:
            ids = batch.column("id")
            rows = [(t.units, *transform_text(t, d)) for t, d in zip(_batch(batch.column("t"), store), ids.to_pylist())]
            n, form, prefix, middle, out = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                 pa.array(middle, pa.int64()), pa.array(out, pa.binary()).view(pa.string())],
                names=["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return src.mapInArrow(run, f"id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
                          ).withColumnRenamed("id", id_col)


def restored(output: str = "output", form: str = "form"):
    """Column: the text of an output. A text that holds a sentinel is plain, so
    the parts of the others stand between exactly three of them."""
    parts = F.split(F.col(output), "<[PSM]>")
    return (F.when(F.col(form) == "psm", F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2))))
            .when(F.col(form) == "spm", F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1))))
            .otherwise(F.col(output)))


def digest(transformed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Sizes and form of every document, sha256 of the output and of the text
    rebuilt from it."""
    return transformed.select(
        F.col(id_col).alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored().cast("binary"), 256).alias("restored_sha256"))
