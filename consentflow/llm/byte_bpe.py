"""Byte-level BPE encoding and decoding by overlapping chunks (operator 9).

Texts of up to ``chunk`` characters are encoded as they are. Longer ones are
cut into chunks that overlap by ``overlap`` characters; the chunks are dealt
over the cluster and pre-tokenised independently. Pre-tokens of two neighbours
*resynchronise*: from a boundary that both have, both go on alike. Each chunk
therefore reports the boundaries it is sure of inside its overlaps, neighbours
are cut at the first boundary they share that follows a non-blank character
(a blank run would otherwise read its end as the end of the text), and the
pieces between cuts are encoded on their own. Where an overlap holds no shared
boundary (a run of one class longer than the overlap) there is no cut and the
chunks are encoded as one piece.

Defined cases: null and empty texts have no ids; an empty table gives an
empty result; repeated rows each give a row;
long copies are pre-tokenised once and each copy gets the ids; a null id is kept
(texts are named by their sha256, never by the id); extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 1 << 16
OVERLAP = 1 << 10
# A contraction is the longest look ahead of a pre-token that has ended.
LOOK = 3


@lru_cache(maxsize=2)
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def _splitter(pattern: str):
    import regex

    return regex.compile(pattern)


def sure_ends(chunk: str, pattern: str, last: bool) -> list[int]:
    """Ends of pre-tokens that the text after the chunk cannot change."""
    n = len(chunk)
    return [m.end() for m in _splitter(pattern).finditer(chunk)
            if last or (m.end() < n and m.start() + LOOK <= n)]


def resync(left: list[int], right: list[int], text_at) -> int | None:
    """The first shared boundary that follows a non-blank character."""
    for p in sorted(set(left) & set(right)):
        if not text_at(p - 1).isspace():
            return p
    return None


def chunk_starts(n: int, chunk: int, overlap: int) -> list[int]:
    """Starts of chunks of ``chunk`` characters that overlap by ``overlap``."""
    step = chunk - overlap
    return list(range(0, max(n - overlap, 1), step))


def encode_long(text: str, enc, pattern: str, chunk: int, overlap: int) -> list[list[int]]:
    """The chunk method on one text (the distributed form's yardstick)."""
    starts = chunk_starts(len(text), chunk, overlap)
    ends = [[s + e for e in sure_ends(text[s:s + chunk], pattern, s + chunk >= len(text))] for s in starts]
    cuts = [0]
    for i in range(len(starts) - 1):
        lo, hi = starts[i + 1], starts[i] + chunk
        p = resync([e for e in ends[i] if lo < e <= hi], [e for e in ends[i + 1] if lo < e <= hi], text.__getitem__)
        if p is not None:
            cuts.append(p)
    return [enc.encode_ordinary(text[a:b]) for a, b in zip(cuts, cuts[1:] + [len(text)])]


def _ids_bytes(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


def _encode_text(rows: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Replace the last column, a text, by its ``ids``."""
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]) + ", ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoding(ranks_path, pattern)
        for b in batches:
            ids = [_ids_bytes(enc.encode_ordinary(t)) for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(ids, pa.binary())], names=[*b.schema.names[:-1], "ids"])

    return rows.mapInArrow(run, ddl)


def chunk_table(long: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """Chunks of texts ``t`` named by key ``k``: one row per key and number.

    Copies share a key, so each is pre-tokenised once; the exchange that drops
    them also deals the chunks of one text over the cluster."""
    starts = F.sequence(F.lit(0), F.length("t") - overlap - 1, F.lit(chunk - overlap))
    parts = F.transform(starts, lambda s: F.struct(s.cast("long").alias("s"), F.substring(F.col("t"), s + 1, F.lit(chunk)).alias("part")))
    return (long.select("k", F.length("t").cast("long").alias("n"), F.posexplode(parts).alias("no", "c"))
            .select("k", "n", "no", "c.s", "c.part").dropDuplicates(["k", "no"]))


def cut_table(chunks: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """For each chunk: where its own part starts and ends, and the number of
    the piece that it belongs to. Only boundaries inside overlaps are moved."""
    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            heads, tails = [], []
            for s, n, part in zip(b.column("s").to_pylist(), b.column("n").to_pylist(), b.column("part").to_pylist()):
                ends = [e for e in sure_ends(part, pattern, s + len(part) >= n) if not part[e - 1].isspace()]
                heads.append([s + e for e in ends if 0 < e <= overlap])
                tails.append([s + e for e in ends if e > chunk - overlap])
            yield pa.RecordBatch.from_arrays(
                [b.column("k"), b.column("no"), b.column("s"), b.column("n"), pa.array(heads, pa.list_(pa.int64())),
                 pa.array(tails, pa.list_(pa.int64()))], names=["k", "no", "s", "n", "head", "tail"])

    ends = chunks.select("k", "no", "s", "n", "part").mapInArrow(
        bounds, "k string, no int, s bigint, n bigint, head array<bigint>, tail array<bigint>")
    w = Window.partitionBy("k").orderBy("no")
    cut = F.array_min(F.array_intersect("head", F.coalesce(F.lag("tail").over(w), F.array().cast("array<bigint>"))))
    own = ends.select("k", "no", "s", "n", F.when(F.col("no") == 0, F.lit(0)).otherwise(cut).alias("cut"))
    start = F.coalesce("cut", "s")
    return own.select(
        "k", "no", (start - F.col("s")).alias("skip"),
        (F.coalesce(F.lead(start).over(w), F.col("n")) - start).alias("size"),
        F.sum(F.col("cut").isNotNull().cast("int")).over(w).alias("piece"))


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row per document: its id and ``ids`` (little-endian unsigned 32 bit)."""
    if not LOOK < overlap < chunk:
        raise ValueError("overlap must be more than a contraction and less than chunk")
    src = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("t"))
    whole = _encode_text(src.where(F.length("t") <= chunk), ranks_path, pattern)

    long = src.where(F.length("t") > chunk).withColumn("k", F.sha2(F.col("t").cast("binary"), 256))
    chunks = chunk_table(long, chunk, overlap)
    cuts = cut_table(chunks, pattern, chunk, overlap)
    own = chunks.join(cuts, ["k", "no"]).select(
        "k", "piece", "no", F.expr("substring(part, CAST(skip + 1 AS int), CAST(size AS int))").alias("own"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("no", "own"))), lambda x: x.own), "")
    pieces = _encode_text(own.groupBy("k", "piece").agg(joined.alias("t")), ranks_path, pattern)
    all_ids = F.aggregate(F.sort_array(F.collect_list(F.struct("piece", "ids"))), F.lit(b""),
                          lambda acc, x: F.concat(acc, x.ids))
    encoded = pieces.groupBy("k").agg(all_ids.alias("ids"))
    return whole.unionByName(long.select("id", "k").join(encoded, "k").select("id", "ids")).withColumnRenamed("id", id_col)


def decode_ids(ids: bytes, enc) -> bytes:
    """The raw bytes of all ids, end to end."""
    return enc.decode_bytes(np.frombuffer(ids, "<u4").tolist())


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Add ``decoded`` (bytes) to a table with ``ids``."""
    names = encoded.columns
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields) + ", decoded binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoding(ranks_path, pattern)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([decode_ids(x, enc) for x in b.column("ids").to_pylist()], pa.binary())],
                names=[*names, "decoded"])

    return encoded.mapInArrow(run, ddl)


def digest(encoded: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """Number of ids, sha256 of the ids as text, sha256 of the decoded bytes."""
    src = encoded.select(F.col(id_col).alias("doc_id"), "ids")
    id_type = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoding(ranks_path, pattern)
        names = [str(i) for i in range(enc.max_token_value + 1)]
        for b in batches:
            data = b.column("ids").to_pylist()
            said = [hashlib.sha256(" ".join([names[i] for i in np.frombuffer(x, "<u4").tolist()]).encode()).hexdigest() for x in data]
            raw = [hashlib.sha256(decode_ids(x, enc)).hexdigest() for x in data]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(x) // 4 for x in data], pa.int64()), pa.array(said), pa.array(raw)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return src.mapInArrow(run, f"doc_id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
