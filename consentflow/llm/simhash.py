"""SimHash near-duplicates by multi-index hashing (operator 8).

Every whole text gets a 64-bit fingerprint: each bit is the majority over the
XXH64 hashes of its word shingles. Two fingerprints link when at most
``max_bits`` differ. Links come from multi-index hashing: the fingerprint is cut
into segments; with radii that add up to ``max_bits - segments + 1``, two linked
fingerprints are within its radius in at least one segment. For each segment the
small Hamming ball around its value is enumerated, matches are fetched from the
segment's table, and the complete distance is verified.

Equal fingerprints are one node from the start (a group of copies of any size
is one row), and a node has a bounded number of others within ``max_bits``, so
no step makes pairs of copies. Components are joined up by label propagation.

Defined cases: a null, empty or blank text has fingerprint zero and links like
any other; a text with fewer words than a shingle is one shingle; a bit that half
of the shingles have is 0; an empty table gives an empty result; repeated rows
each give a row; a null id never names a component unless its members have no
other id; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from consentflow.llm.common import stage, text_key
from consentflow.llm.components import components

SEED = 42


def fingerprint(text: str | None, shingle: int) -> int:
    """Unsigned 64-bit SimHash of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[:n - shingle + 1].tolist(), ends[shingle - 1:].tolist())],
                 "<u8")
    ones = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """id, text fingerprint ``k`` and SimHash ``fp`` (as a signed long)."""
    src = docs.select(docs[id_col].alias("id"), text_key(docs[text_col]).alias("k"), docs[text_col].alias("t"))
    id_type = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b.column("t").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("k"), pa.array(fp)], names=["id", "k", "fp"])

    return src.mapInArrow(run, f"id {id_type}, k bigint, fp bigint")


def radii(max_bits: int, segments: int) -> list[int]:
    """A radius a segment, as even as possible, adding up to max_bits - segments + 1."""
    left = max_bits - segments + 1
    if left < 0 or segments < 2:
        raise ValueError("segments must be 2 to max_bits + 1")
    return [left // segments + (i < left % segments) for i in range(segments)]


def _ball(width: int, radius: int) -> list[int]:
    masks = [0]
    for r in range(radius):
        masks = sorted({m | (1 << b) for m in masks for b in range(width)} | set(masks))
    return masks


def links(nodes: DataFrame, max_bits: int, segments: int = 2) -> DataFrame:
    """All pairs (a, b) of different fingerprints within ``max_bits``."""
    width = 64 // segments
    found = None
    for i, radius in enumerate(radii(max_bits, segments)):
        bits = 64 - width * (segments - 1) if i == segments - 1 else width
        value = F.shiftrightunsigned("fp", width * i).bitwiseAND(F.lit((1 << bits) - 1 if bits < 64 else -1))
        stored = nodes.select(F.col("fp").alias("b"), value.alias("key"))
        ball = F.array(*[F.lit(m).cast("long") for m in _ball(bits, radius)])
        probes = nodes.select(F.col("fp").alias("a"), value.alias("v"), F.explode(ball).alias("mask"))
        # of two values that differ, the one with the mask's lowest bit set asks
        low = F.col("mask").bitwiseAND(-F.col("mask"))
        probes = probes.where((F.col("mask") == 0) | (F.col("v").bitwiseAND(low) != 0)).select(
            "a", F.col("v").bitwiseXOR(F.col("mask")).alias("key"), "mask")
        pairs = probes.join(stored, "key").where(
            ((F.col("mask") != 0) | (F.col("a") < F.col("b"))) & F.bit_count(F.col("a").bitwiseXOR(F.col("b"))).between(1, max_bits))
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        found = pairs if found is None else found.unionByName(pairs)
    return found


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text",
                    segments: int = 2) -> DataFrame:
    """id, k (text fingerprint), fp, root and component_id for every row of
    ``docs``. ``root`` names a component; components of one least id (or of null
    ids alone) share a ``component_id``."""
    rows = stage(fingerprints(docs, shingle, id_col, text_col), "simhash")
    nodes = stage(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-nodes")
    roots = components(links(nodes, max_bits, segments)).select(F.col("node").alias("fp"), "root")
    named = nodes.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    member = named.select("fp", "root").join(least, "root").select("fp", "root", "component_id")
    return rows.join(member, "fp")


def deduplicate(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component: the row of the smallest id (of equal ids,
    the smallest text fingerprint; of equal rows, any). All columns of ``docs``."""
    found = near_duplicates(docs, shingle, max_bits, id_col, text_col)
    keep = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "k")).alias("x")).select(
        F.col("x.id").alias("keep_id"), F.col("x.k").alias("keep_k"))
    renamed = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    own_id, own_text = (f"c{docs.columns.index(c)}" for c in (id_col, text_col))
    keyed = renamed.withColumn("keep_k_", text_key(F.col(own_text)))
    kept = keyed.join(keep, keyed[own_id].eqNullSafe(keep["keep_id"]) & (keyed["keep_k_"] == keep["keep_k"]), "left_semi")
    return kept.dropDuplicates([own_id, "keep_k_"]).drop("keep_k_").toDF(*docs.columns)


def digest(found: DataFrame) -> DataFrame:
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
