"""Token-id output with Elias-Fano document boundaries (operator 2).

File format: a Parquet table of *segments*, in shards that follow ascending
document ids. A segment holds consecutive documents:

* ``ids`` -- the concatenated token ids, little-endian, ``width`` bytes each: 2
  where the vocabulary has at most 65,536 ids, else 4;
* ``ends_high``, ``ends_low``, ``ends_select`` -- the running document ends
  (exclusive, within the segment) as an Elias-Fano sequence: ``low_bits`` low
  bits of every value packed, the high parts as a unary bit vector, and the bit
  position of every ``SELECT_STEP``-th one, so that ``end(k)`` is one select and
  one read -- about 2 + log2(ids / documents) bits a document, no 64-bit table;
* ``doc_ids`` -- the documents' ids as offsets to the first, Elias-Fano again
  (null ids are counted in front: nulls sort first);
* ``shard``, ``seq``, ``shard_start`` -- where the segment stands.

Encoding cuts a text only at single spaces between two non-blank characters.
The pre-tokeniser starts a new piece there in any text, so the units encode
alone to the ids they have inside the text, and a worker encodes each distinct
unit once. Units are encoded by the ``tokenizers`` library as loaded: where a
text holds the string of an added token, it gets that token.

Defined cases: null and empty texts hold the end id alone; repeated ids stay
rows of their own, in order of their text's fingerprint; an empty table gives
no segment. A text longer than a segment makes its own segment.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from consentflow.llm.common import stage, text_key

SELECT_STEP = 64
SEGMENT_IDS = 1 << 18
CACHE_UNITS = 500_000  # a generation; two are held
BATCH_CHARS = 1 << 25

SEGMENT_DDL = ("shard int, seq int, shard_start bigint, n_docs bigint, n_ids bigint, width int, ids binary, "
               "ends_low_bits int, ends_low binary, ends_high binary, ends_select binary, "
               "n_null_ids bigint, first_id bigint, ids_low_bits int, ids_low binary, ids_high binary, ids_select binary")


# --- Elias-Fano ------------------------------------------------------------

def _pack(values: np.ndarray, width: int) -> bytes:
    if width == 0 or len(values) == 0:
        return b""
    bits = (values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


class EliasFano:
    """A non-decreasing sequence of unsigned integers."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, select: bytes):
        self.n, self.low_bits, self.low, self.high, self.select = n, low_bits, low, high, select

    @classmethod
    def of(cls, values) -> EliasFano:
        v = np.asarray(values, dtype=np.uint64)
        n = len(v)
        if n == 0:
            return cls(0, 0, b"", b"", b"")
        low_bits = max(0, (int(v[-1]) // n).bit_length() - 1)
        ones = (v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1, dtype=np.uint8)
        bits[ones] = 1
        return cls(n, low_bits, _pack(v & np.uint64((1 << low_bits) - 1), low_bits),
                   np.packbits(bits, bitorder="little").tobytes(),
                   ones[::SELECT_STEP].astype("<u4").tobytes())

    def _low(self, k: int) -> int:
        at = k * self.low_bits
        chunk = int.from_bytes(self.low[at >> 3:(at + self.low_bits + 7) >> 3], "little")
        return (chunk >> (at & 7)) & ((1 << self.low_bits) - 1)

    def get(self, k: int) -> int:
        """The k-th value: a select on the high bits from the nearest sample."""
        pos = int.from_bytes(self.select[4 * (k // SELECT_STEP):4 * (k // SELECT_STEP) + 4], "little")
        left = k % SELECT_STEP
        byte, word = pos >> 3, self.high[pos >> 3] >> (pos & 7) << (pos & 7)
        while (ones := word.bit_count()) <= left:
            left -= ones
            byte += 1
            word = self.high[byte]
        for _ in range(left):
            word &= word - 1
        pos = 8 * byte + (word & -word).bit_length() - 1
        return ((pos - k) << self.low_bits) | self._low(k)

    def all(self) -> np.ndarray:
        """Every value at once, for readers of the whole segment."""
        if self.n == 0:
            return np.zeros(0, np.int64)
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))[:self.n]
        out = (ones - np.arange(self.n)) << self.low_bits
        if self.low_bits:
            bits = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little")[:self.n * self.low_bits]
            out = out + bits.reshape(self.n, self.low_bits).astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))
        return out


# --- encoding --------------------------------------------------------------

@lru_cache(maxsize=4)
def _tokenizer(path: str, plain_special: bool = False):
    """The library's tokenizer as loaded; with ``plain_special``, the strings of
    its special tokens are ordinary text."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = plain_special
    t.model._resize_cache(0)  # each unit comes once: the library's own store only costs time
    return t


# Blanks of the pre-tokeniser other than the space and the line feed (a few more do no harm).
OTHER_BLANKS = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(
    map(chr, range(0x2000, 0x200B)))
# A text in which some space does not stand between non-blank characters.
IRREGULAR = r"^ | $|  | \n|\n |[" + "".join(OTHER_BLANKS) + "]"
GLUE = "\t"
GLUED = 64


def units(text: str) -> list[str]:
    """Cut before every single space that stands between non-blank characters;
    the first unit, then the others without that space."""
    parts = text.split(" ")
    out = [parts[0]]
    for a, b in zip(parts, parts[1:]):
        if a and b and not a[-1].isspace() and not b[0].isspace():
            out.append(b)
        else:
            out[-1] += " " + b
    return out


def split_units(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Units of all texts end to end, and the offsets of every text's units."""
    split = pc.split_pattern(texts, " ")
    odd = pc.match_substring_regex(texts, IRREGULAR).to_numpy(zero_copy_only=False)
    if odd.any():
        # only these texts' units pass Python
        at = np.flatnonzero(odd).tolist()
        own = pa.array([units(texts[i].as_py()) for i in at], split.type)
        parts = [x for i, (a, b) in enumerate(zip([-1, *at], [*at, len(split)])) for x in (own[max(i - 1, 0):i], split[a + 1:b])]
        split = pa.concat_arrays(parts)
        del parts, own
    offsets = split.offsets.to_numpy()
    return offsets - offsets[0], split.flatten()


def put_together(parts: list[bytes], place: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """For every text, the bytes of its units (``parts[place]``) end to end."""
    ends = np.concatenate([[0], np.cumsum([len(x) for x in parts])])
    return slices_of(pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(parts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(b"".join(parts))]), place, offsets)


def slices_of(table: pa.Array, place: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """The bytes of ``table[place]`` end to end, cut where ``offsets`` say."""
    if len(place) == 0:
        return [b""] * (len(offsets) - 1)
    taken = table.take(pa.array(place))
    at, data = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset:], memoryview(taken.buffers()[2])
    cut = at[offsets].tolist()
    return [bytes(data[a:b]) for a, b in zip(cut, cut[1:])]


class UnitEncoder:
    """Encodes texts by their distinct units; the store is emptied when it is
    full, which changes the time taken and nothing else.

    The strings of added tokens in a text give these tokens, as the library does
    when loaded (``plain_special`` turns that off). Such a string ends at the
    cuts too, so its unit is encoded alone; were it to hold a blank itself, its
    texts would be encoded whole.

    Words are split, made distinct and put back in order by Arrow kernels;
    Python sees each distinct unit of a batch once. New units go to the library
    glued by tabs, 64 at a time: no unit holds a tab, and the pre-tokeniser
    makes a piece of its own of a tab that has a non-blank character before it
    and at most one space behind it. Others are encoded alone."""

    def __init__(self, path: str, limit: int = CACHE_UNITS, plain_special: bool = False):
        self.tok, self.limit = _tokenizer(path, plain_special), limit
        added = [] if plain_special else [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.whole = re.compile("|".join(map(re.escape, blank))) if (blank := [t for t in added if re.search(r"\s", t)]) else None
        self.width = 2 if max(self.tok.get_vocab().values()) < 1 << 16 else 4
        self.kind = f"<u{self.width}"
        self.glue = self._alone([GLUE])[0]
        # ids of units with the space in front; the older half goes when the younger is full
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _alone(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_units(self, found: list[str]) -> list[bytes]:
        """Ids of units that stand behind a space."""
        plain = [u for u in found if u and GLUE not in u and not u[0].isspace() and not u[-1].isspace()
                 and not (self.added and self.added.search(u))]
        ids: dict[str, bytes] = {}
        if len(self.glue) == self.width:
            glue, width = int.from_bytes(self.glue, "little"), self.width
            for i in range(0, len(plain), GLUED << 6):
                part = plain[i:i + (GLUED << 6)]
                texts = [(GLUE + " ").join(part[j:j + GLUED]) for j in range(0, len(part), GLUED)]
                at = 0
                for e in self.tok.encode_batch_fast([" " + t for t in texts], add_special_tokens=False):
                    data = np.array(e.ids, self.kind)
                    ends = np.flatnonzero(data == glue).tolist()
                    raw, start = data.tobytes(), 0
                    for end in [*ends, len(data)]:
                        ids[part[at]] = raw[width * start:width * end]
                        start, at = end + 1, at + 1
        rest = [u for u in found if u not in ids]
        ids.update(zip(rest, self._alone([" " + u for u in rest])))
        return [ids[u] for u in found]

    def _lookup(self, found: list[str]) -> list[bytes]:
        if len(self.known) > self.limit:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        new = [u for u in found if u not in known]
        if older:
            known.update((u, older[u]) for u in new if u in older)
            new = [u for u in new if u not in known]
        known.update(zip(new, self._encode_units(new)))
        return [known[u] for u in found]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of every text, little-endian, ``width`` bytes each (nulls are empty)."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        offsets, words = split_units(texts)
        heads = words.take(pa.array(offsets[:-1])).to_pylist()
        coded = words.dictionary_encode()
        del words  # units are as many as words, so none of their columns outlives its use
        place, found = coded.indices.to_numpy().copy(), coded.dictionary.to_pylist()
        del coded
        place[offsets[:-1]] = len(found) + np.arange(len(heads))  # a text's first unit has no space in front
        # a word that only ever comes first would be looked up for nothing, and harmlessly
        out = put_together(self._lookup(found) + self._alone(heads), place, offsets)
        if self.whole:
            for i, t in enumerate(texts.to_pylist()):
                if self.whole.search(t):
                    out[i] = self._alone([t])[0]
        return out


@lru_cache(maxsize=1)
def _encoder(path: str) -> UnitEncoder:
    return UnitEncoder(path)


def _segment(shard, seq, start, width, doc_ids, ids: list[bytes]) -> dict:
    ends = EliasFano.of(np.cumsum([len(x) // width for x in ids]))
    known = [d for d in doc_ids if d is not None]
    first = known[0] if known else 0
    names = EliasFano.of([d - first for d in known])
    data = b"".join(ids)
    return {"shard": shard, "seq": seq, "shard_start": start, "n_docs": len(ids), "n_ids": len(data) // width, "width": width, "ids": data,
            "ends_low_bits": ends.low_bits, "ends_low": ends.low, "ends_high": ends.high, "ends_select": ends.select,
            "n_null_ids": len(doc_ids) - len(known), "first_id": first, "ids_low_bits": names.low_bits,
            "ids_low": names.low, "ids_high": names.high, "ids_select": names.select}


SEGMENT_ARROW = pa.schema([
    ("shard", pa.int32()), ("seq", pa.int32()), ("shard_start", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("width", pa.int32()),
    ("ids", pa.binary()), ("ends_low_bits", pa.int32()), ("ends_low", pa.binary()), ("ends_high", pa.binary()),
    ("ends_select", pa.binary()), ("n_null_ids", pa.int64()), ("first_id", pa.int64()), ("ids_low_bits", pa.int32()),
    ("ids_low", pa.binary()), ("ids_high", pa.binary()), ("ids_select", pa.binary())])


def larger_batches(batches: Iterator[pa.RecordBatch], size: int = BATCH_CHARS) -> Iterator[pa.RecordBatch]:
    """Batches put together up to ``size`` bytes: fewer look-ups of one unit."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(x.nbytes for x in held) >= size:
            whole, held = pa.Table.from_batches(held).combine_chunks().to_batches()[0], []
            del b  # the parts are let go of before the whole is worked on
            yield whole
            del whole
    if held and sum(x.num_rows for x in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def encode_segments(docs: DataFrame, tokenizer_path: str, end_id: int = 2, id_col: str = "doc_id",
                    text_col: str = "text", segment_ids: int = SEGMENT_IDS) -> DataFrame:
    """Segments of all documents in ascending order of id (nulls first)."""
    spark = docs.sparkSession
    src = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("t"), text_key(docs[text_col]).alias("k"))
    # ranges over (id, fingerprint): an id that repeats without end still spreads
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    ordered = src.repartitionByRange(n, "id", "k").sortWithinPartitions("id", "k").drop("k")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, enc = TaskContext.get().partitionId(), _encoder(tokenizer_path)
        width = enc.width if end_id < 1 << 8 * enc.width else 4
        tail = end_id.to_bytes(width, "little")
        doc_ids: list = []
        ids: list[bytes] = []
        seq = start = held = 0
        for b in larger_batches(batches):
            got = enc.encode(b.column("t"))
            if width != enc.width:
                got = [np.frombuffer(x, enc.kind).astype("<u4").tobytes() for x in got]
            for d, x in zip(b.column("id").to_pylist(), got):
                doc_ids.append(d)
                ids.append(x + tail)
                held += len(x) // width + 1
                if held >= segment_ids:
                    yield pa.RecordBatch.from_pylist([_segment(shard, seq, start, width, doc_ids, ids)], SEGMENT_ARROW)
                    seq, start, held, doc_ids, ids = seq + 1, start + held, 0, [], []
        if ids:
            yield pa.RecordBatch.from_pylist([_segment(shard, seq, start, width, doc_ids, ids)], SEGMENT_ARROW)

    return ordered.mapInArrow(write, SEGMENT_DDL)


def read_documents(segments: DataFrame) -> DataFrame:
    """Documents of written segments: id, start over the whole table, ids.

    Shard totals are summed first (one row a shard), so the running start is a
    window over as many rows as there are shards; they join by shard number."""
    totals = segments.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    w = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("base"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                ends = EliasFano(r["n_docs"], r["ends_low_bits"], r["ends_low"], r["ends_high"], r["ends_select"]).all()
                known = EliasFano(r["n_docs"] - r["n_null_ids"], r["ids_low_bits"], r["ids_low"], r["ids_high"],
                                  r["ids_select"]).all() + r["first_id"]
                doc_ids = [None] * r["n_null_ids"] + known.tolist()
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                data = memoryview(np.frombuffer(r["ids"], f"<u{r['width']}").astype("<u4")).cast("B")
                yield pa.RecordBatch.from_arrays([
                    pa.array([r["shard"]] * len(ends), pa.int32()), pa.array(doc_ids, pa.int64()),
                    pa.array(starts + r["shard_start"], pa.int64()), pa.array(ends - starts, pa.int64()),
                    pa.array([zlib.crc32(data[4 * s:4 * e]) for s, e in zip(starts.tolist(), ends.tolist())], pa.int64())],
                    names=["shard", "doc_id", "start", "n_tokens", "ids_crc32"])

    rows = segments.drop("n_ids", "seq").mapInArrow(
        split, "shard int, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    return rows.join(bases, "shard").select(
        "doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")


def token_output(docs: DataFrame, tokenizer_path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
                 segment_ids: int = SEGMENT_IDS) -> DataFrame:
    """Write all documents in the file format, read the files back: one row per
    document with its start, number of ids and crc32 of the ids."""
    return read_documents(stage(encode_segments(docs, tokenizer_path, end_id, id_col, text_col, segment_ids), "token-ids"))
