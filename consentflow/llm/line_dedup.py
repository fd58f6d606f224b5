"""Line deduplication by an exact set-similarity join (operator 5, native).

A line (text between line feeds) is the set of its words (between ASCII blanks).
A line goes when an earlier line -- of a smaller id, or further up in the same
text -- has a Jaccard similarity of at least ``similarity``; whether that
earlier line itself stays does not matter. Lines without words always stay.

1. Texts are numbered in the order of ids, so that a line's place is one number.
2. Every text is cut once; the sets (sorted word hashes) are staged, and all later
   steps read them. Equal sets are one class, named by its first place; copies
   never meet again.
3. Words are counted by hash bucket over all lines; every set is ordered by
   (level of the bucket's count, word hash), rarest first -- one order for all.
4. Prefix filter: two sets that are similar enough share a word in their first
   n - ceil(similarity * n) + 1. Classes that share one are joined; the length
   filter, the positional filter and a bound on the overlap from parity bits drop
   pairs where they are made.
   A word of more than ``hot`` classes is split by size band and into blocks.
5. Before that, of the last ``LAST`` words of each prefix (the ones that near copies
   share), a class meets the first class and the ``NEAR`` before it, so that a large
   group of near copies leaves few classes open.
6. The Jaccard similarity of the remaining pairs is verified on the whole sets.

Only DataFrame functions run. Words are compared by 64 bits of a hash (in prefixes
by 56, which can only add candidates), sets are named by 128. What passes the
driver: ``BUCKETS`` counts and the number of texts of each partition.

Defined cases: a null text is kept as null and has no lines; an empty text has
one empty line; an empty table gives an empty result; null ids come first; rows
that repeat an id and a text stand in the same place and are treated alike; where
ids repeat with other texts, ties of (id, line number) are broken by the texts'
fingerprints; extra columns pass through ``deduplicate`` whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from consentflow.llm.common import stage, text_key, unstage

BLANKS = r"[\x20\x09-\x0D]+"
BUCKETS = 1 << 16  # a constant of one plan
LEVEL = 56  # bits below the level in a word's key
NEAR = 16
LAST = 4
FEW = 64
HOT = 1_000
PARTS = 2
WIDE = 48  # words from which a set has 128 parities, not 64
EPS = 1e-9


def number(docs: DataFrame) -> tuple[DataFrame, int, int]:
    """Texts (id, k) once each, numbered: ``seq`` ascends with the id, ``sub``
    counts an id's texts. Also a bound of a text's lines (0: no texts), and the
    most rows of a text. docs: id, k, t (no nulls)."""
    spark = docs.sparkSession
    once = docs.groupBy("id", "k").agg((F.max(F.octet_length("t")) + 1).cast("bigint").alias("lines"), F.count("*").alias("rows"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["id", "k"]
    at = stage(once.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn(
        "at", F.monotonically_increasing_id()), "line-texts")
    part = F.shiftright("at", 33)
    found = at.groupBy(part.alias("p")).agg(F.count("*").alias("c"), F.max("lines").alias("lines"), F.max("rows").alias("rows")).collect()
    sizes = {r.p: r.c for r in found}
    before, total = [], 0
    for p in range(max(sizes, default=-1) + 1):
        before.append(total)
        total += sizes.get(p, 0)
    dense = F.get(F.array(*[F.lit(b) for b in before] or [F.lit(0)]).cast("array<bigint>"), part.cast("int")) + F.col("at").bitwiseAND((1 << 33) - 1)
    at = at.withColumn("at", dense)
    firsts = at.groupBy("id").agg(F.min("at").alias("seq")).withColumnRenamed("id", "id_")
    numbered = stage(at.join(firsts, at["id"].eqNullSafe(firsts["id_"])).select(
        "id", "k", "seq", (F.col("at") - F.col("seq")).alias("sub")), "line-numbers")
    unstage(at)
    return numbered, max((r.lines for r in found), default=0), max((r.rows for r in found), default=0)


def words_of(line: Column) -> Column:
    """Words of a line, and empty strings; the common case needs no pattern."""
    other = F.contains(line, F.lit("\t")) | F.contains(line, F.lit("\r")) | F.contains(line, F.lit("\x0b")) | F.contains(line, F.lit("\f"))
    return F.when(other, F.split(line, BLANKS)).otherwise(F.split(line, " "))


def set_of(line: Column) -> Column:
    """Sorted hashes of a line's distinct words."""
    hashed = F.array_distinct(F.transform(words_of(line), lambda w: F.xxhash64(w)))
    return F.sort_array(F.array_remove(hashed, F.xxhash64(F.lit(""))))


def line_sets(texts: DataFrame, step: int) -> DataFrame:
    """One row a line with words: its place, the set's name of 128 bits, the set.
    texts: base (place of the first line) and t; ``step`` from line to line."""
    lines = texts.select("base", F.posexplode(F.split("t", "\n")).alias("no", "line")).where(
        F.btrim("line", F.lit(" \t\n\x0b\f\r")) != "")
    sets = lines.select((F.col("base") + F.col("no").cast("bigint") * F.lit(step)).alias("place"), set_of(F.col("line")).alias("s"))
    return sets.select("place", F.xxhash64("s").alias("h1"), F.xxhash64(F.lit(1), "s").alias("h2"), "s")


def level(count: int) -> int:
    """Quarters of a power of two: grows with the count, below 128."""
    return int(4 * math.log2(count + 1))


def rarity(sets: DataFrame) -> Column:
    """Array over buckets of word hashes: the level of the bucket's count."""
    words = sets.select(F.explode("s").alias("h"))
    found = [0] * BUCKETS
    for r in words.groupBy(F.col("h").bitwiseAND(F.lit(BUCKETS - 1)).alias("b")).count().collect():
        found[r.b] = level(r["count"])
    return F.split(F.lit(",".join(map(str, found))), ",").cast("array<bigint>")


def prefixes(sets: DataFrame, levels: Column, similarity: float) -> DataFrame:
    """Size, parities and prefix of every set that another can be similar to."""
    n = F.size("s")
    least = math.ceil(similarity / (1 - similarity) - EPS) if similarity < 1 else (1 << 31) - 1
    keys = F.sort_array(F.transform("s", lambda h: F.shiftleft(F.get(levels, h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")), LEVEL).bitwiseOR(
        F.shiftrightunsigned(h, 64 - LEVEL))))

    def parity(word: str) -> Column:
        return F.expr(f"aggregate(s, 0L, (a, h) -> a ^ shiftleft({word}, CAST(h & 63L AS INT)))")

    # of all words, and of those with the next bit set
    return sets.where(n >= least).select(
        F.col("place").alias("cid"), n.alias("n"), parity("1L").alias("sig"), F.when(n >= WIDE, parity("shiftright(h, 6) & 1L")).otherwise(F.lit(0)).alias("sig2"),
        F.slice(keys, F.lit(1), n - F.ceil(n * similarity - EPS).cast("int") + 1).alias("prefix"))


COLS = ("cid", "n", "i", "sig", "sig2")


def _as(name: str) -> list[Column]:
    return [F.col(c).alias(f"{name}{c}") for c in COLS]


def _apart() -> Column:
    """Parities that differ: at most the words that only one of both sets has."""
    wide = (F.col("xn") >= WIDE) & (F.col("yn") >= WIDE)
    all_, upper = F.col("xsig").bitwiseXOR(F.col("ysig")), F.col("xsig2").bitwiseXOR(F.col("ysig2"))
    return F.when(wide, F.bit_count(all_.bitwiseXOR(upper)) + F.bit_count(upper)).otherwise(F.bit_count(all_))


def may_match(similarity: float) -> Column:
    """An earlier class within the length filter; parity filter (too many words
    in one set alone); positional filter (the shared words before a place and
    after it are too few)."""
    total = F.col("xn") + F.col("yn")
    need = F.ceil(total * (similarity / (1 + similarity)) - EPS).cast("int")
    best = F.least("xi", "yi") + F.least(F.col("xn") - F.col("xi"), F.col("yn") - F.col("yi"))
    return ((F.col("ycid") < F.col("xcid")) & (F.least("xn", "yn") >= similarity * F.greatest("xn", "yn") - EPS)
            & (_apart() <= total - 2 * need) & (best >= need))


def _pair() -> list[Column]:
    return [F.col("xcid").alias("x"), F.col("ycid").alias("y"), _apart().cast("int").alias("apart")]


def verify(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Classes ``x`` that have a verified partner ``y``."""
    need = stage(pairs.select(F.col("x").alias("place")).union(pairs.select("y")).distinct(), "line-need")
    held = sets.select("place", "s").join(need, "place")
    both = pairs.join(held.toDF("x", "xs"), "x").join(held.toDF("y", "ys"), "y")
    common = F.size(F.array_intersect("xs", "ys"))
    similar = common >= similarity * (F.size("xs") + F.size("ys") - common) - EPS
    out = stage(both.where(similar).select("x").distinct(), "line-verified")
    unstage(need)
    return out


def near_pairs(words: DataFrame, similarity: float, hot: int) -> DataFrame:
    """Pairs (x, y) of a class and the most alike of the first one and the
    ``NEAR`` before it, of words of more than ``FEW`` classes, block by block."""
    many = words.groupBy("w").count().where(F.col("count") > FEW).select("w", F.ceil(F.col("count") / max(hot, FEW)).alias("blocks"))
    many = stage(many, "line-many")
    order = Window.partitionBy("w", "block").orderBy("cid")
    me = F.struct(*COLS)
    near = F.concat(F.array(F.first(me).over(order)), F.collect_list(me).over(order.rowsBetween(-NEAR, -1)))
    dealt = words.join(many, "w").withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")))
    met = dealt.select(*_as("x"), near.alias("near")).withColumn("y", F.explode("near")).select(
        *[f"x{c}" for c in COLS], *[F.col(f"y.{c}").alias(f"y{c}") for c in COLS])
    return met.where(may_match(similarity)).select(*_pair()).groupBy("x").agg(F.min_by("y", "apart").alias("y"))


def hot_pairs(words: DataFrame, blocks: DataFrame, similarity: float) -> DataFrame:
    """Pairs of words with many classes: open classes visit all blocks of their
    size band and its neighbours, where the length filter leaves sizes."""
    keys = ["w", "band", "block"]
    y = words.join(blocks, ["w", "band"]).withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks"))).select(*keys, *_as("y"))
    x = words.where("open").withColumn("band", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1))).join(
        blocks, ["w", "band"]).withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    return x.select(*keys, *_as("x")).join(y, keys).where(may_match(similarity)).select(*_pair())


def matched_classes(classes: DataFrame, sets: DataFrame, similarity: float, hot: int = HOT) -> DataFrame:
    """Classes ``x`` (their places) with an earlier similar class."""
    log = math.log(1 / similarity) if similarity < 1 else 1.0
    of = F.posexplode("prefix").alias("i", "w")
    # near copies share the last words of a prefix: the first ones are their own
    last = classes.select("cid", "n", "sig", "sig2", F.size("prefix").alias("p"), of).where(F.col("i") >= F.col("p") - LAST)
    near = stage(near_pairs(last.drop("p"), similarity, hot), "line-near")
    settled = verify(near, sets, similarity)
    unstage(near)

    words = classes.join(settled.select(F.col("x").alias("cid"), F.lit(False).alias("still")), "cid", "left").select(
        "cid", "n", "sig", "sig2", F.coalesce("still", F.lit(True)).alias("open"), of)
    band = F.floor(F.log(F.col("n")) / log).cast("int").alias("band")
    # a word has no more classes than its bucket has words, so few words are counted one by one
    counted = stage(words.where(F.shiftrightunsigned("w", LEVEL) >= level(hot)).groupBy("w", band).count(), "line-counts")
    many = counted.groupBy("w").agg(F.sum("count").alias("c")).where(F.col("c") > hot).select("w")
    blocks = stage(counted.join(many, "w", "left_semi").select("w", "band", F.ceil(F.col("count") / hot).alias("blocks")), "line-blocks")
    unstage(counted)
    met = []
    if not blocks.isEmpty():
        named = blocks.select("w").distinct()
        hot_words = words.join(named, "w", "left_semi").withColumn("band", band)
        met.append(stage(hot_pairs(hot_words, blocks, similarity).distinct(), "line-hot-pairs"))
        words = words.join(named, "w", "left_anti")
    # one part of the words after the other, so that their rows hold less disk at once
    for part in range(PARTS):
        some = words.where(F.col("w").bitwiseAND(F.lit(PARTS - 1)) == part)
        pairs = some.select("w", "open", *_as("x")).join(some.select("w", F.col("open").alias("any"), *_as("y")), "w")
        # a condition on both sides stays in the join, which then reads one exchange twice
        still = F.col("open").cast("int") * 2 + F.col("any").cast("int") >= 2
        met.append(stage(pairs.where(may_match(similarity) & still).select(*_pair()).distinct(), "line-pairs"))
    found = met[0]
    for m in met[1:]:
        found = found.union(m)
    # one partner is enough: the most alike first, then all of the classes still open
    best = verify(found.groupBy("x").agg(F.min_by("y", "apart").alias("y")), sets, similarity)
    rest = verify(found.join(best, "x", "left_anti").distinct(), sets, similarity)
    for m in met:
        unstage(m)
    return settled.union(best).union(rest)


def removed_lines(docs: DataFrame, similarity: float = 0.8, hot: int = HOT) -> DataFrame:
    """(id, k, no) of the lines that go; docs: id, k, t (no nulls). A word of
    more than ``hot`` classes is split; this changes the work alone."""
    numbers, lines, rows = number(docs)
    if not lines:
        return numbers.select("id", "k", F.lit(0).alias("no"))
    # a place: id, line number, text of the id
    step = numbers.agg(F.max("sub")).first()[0] + 1
    per = lines * step
    texts = docs.dropDuplicates(["id", "k"]) if rows > 1 else docs
    at = numbers.select(F.col("id").alias("id_"), F.col("k").alias("k_"), (F.col("seq") * F.lit(per) + F.col("sub")).alias("base"))
    texts = texts.join(at, texts["id"].eqNullSafe(at["id_"]) & (texts["k"] == at["k_"])).select("base", "t")
    # word hashes repeat: a dictionary holds each once a file
    sets = stage(line_sets(texts, step), "line-sets", **{"parquet.dictionary.page.size": 16 << 20})
    names = sets.groupBy("h1", "h2").agg(F.min("place").alias("cid"))
    member = stage(sets.select("h1", "h2", "place").join(names, ["h1", "h2"]).select("place", "cid"), "line-members")
    late = member.where("place <> cid").select(F.col("place").alias("cid"))
    classes = prefixes(sets, rarity(sets), similarity).join(late.hint("shuffle_hash"), "cid", "left_anti")
    classes = stage(classes, "line-classes")
    gone = matched_classes(classes, sets, similarity, hot).select(F.col("x").alias("cid"), F.lit(True).alias("gone"))
    unstage(classes)
    unstage(sets)
    out = member.join(gone, "cid", "left").where(F.coalesce("gone", F.lit(False)) | F.expr(f"place div {step}L <> cid div {step}L"))
    out = out.select(F.expr(f"place div {per}L").alias("seq"), F.expr(f"place % {step}L").alias("sub"),
                     F.expr(f"CAST(place % {per}L div {step}L AS INT)").alias("no"))
    return out.join(numbers, ["seq", "sub"]).select("id", "k", "no")


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(docs[id_col].alias("id"), text_key(docs[text_col]).alias("k"), docs[text_col].alias("t"))


def deduplicate(docs: DataFrame, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text",
                extra: bool = False) -> DataFrame:
    """All columns of ``docs``, the text without the lines that go; with
    ``extra``, also the numbers of lines and of lines removed (last columns)."""
    gone = removed_lines(_source(docs.where(docs[text_col].isNotNull()), id_col, text_col), similarity)
    # as many numbers as a text has lines
    gone = stage(gone.groupBy(F.col("id").alias("id_"), F.col("k").alias("k_")).agg(F.collect_set("no").alias("gone_")), "removed-lines")
    names = [f"c{i}" for i in range(len(docs.columns))]
    renamed = docs.toDF(*names)
    own_id, own_text = (names[docs.columns.index(c)] for c in (id_col, text_col))
    joined = renamed.join(gone, renamed[own_id].eqNullSafe(gone["id_"]) & (text_key(renamed[own_text]) == gone["k_"]), "left")
    lines = F.split(F.col(own_text), "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "gone_")
    # the outer variable holds the lines, so that a text is split once and not for each line left
    cut = F.when(F.col("gone_").isNull(), F.col(own_text)).otherwise(
        F.array_join(F.get(F.transform(F.array(lines), lambda cut: F.transform(left, lambda i: F.get(cut, i))), F.lit(0)), "\n"))
    out = [cut.alias(c) if c == own_text else F.col(c) for c in names]
    counts = [F.when(F.col(own_text).isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
              F.coalesce(F.size("gone_"), F.lit(0)).cast("long").alias("n_removed")] if extra else []
    return joined.select(*out, *counts).toDF(*docs.columns, *(["n_lines", "n_removed"] if extra else []))


def digest(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """Per document: numbers of lines and of lines removed, digest of the text left."""
    out = deduplicate(docs.select("doc_id", "text"), similarity, extra=True)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))


ORACLE_SQL = """
WITH l AS (
  SELECT doc_id, unnest(range(len(x))) AS no, unnest(x) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents WHERE text IS NOT NULL)),
s AS (
  SELECT *, list_sort(list_distinct(list_filter(regexp_split_to_array(line, '[\\x20\\x09-\\x0D]+'), lambda w: w <> ''))) AS s FROM l),
c AS (
  SELECT row_number() OVER (ORDER BY f.doc_id, f.no) AS cid, s, len(s) AS n, f
  FROM (SELECT s, min({'doc_id': doc_id, 'no': no}) AS f FROM s WHERE len(s) > 0 GROUP BY s)),
t AS (SELECT cid, n, unnest(s) AS w FROM c),
r AS (
  SELECT cid, n, w, row_number() OVER (PARTITION BY cid ORDER BY df, w) AS i
  FROM t JOIN (SELECT w, count(*) AS df FROM t GROUP BY w) USING (w)),
p AS (SELECT * FROM r WHERE i <= n - ceil(0.8 * n - 1e-9) + 1),
q AS (SELECT DISTINCT y.cid AS a, x.cid AS b FROM p x JOIN p y ON x.w = y.w AND y.cid < x.cid AND least(x.n, y.n) >= 0.8 * greatest(x.n, y.n) - 1e-9),
m AS (
  SELECT DISTINCT b AS cid FROM (
    SELECT b, x.n + y.n AS total, len(list_intersect(x.s, y.s)) AS common FROM q JOIN c x ON x.cid = a JOIN c y ON y.cid = b)
  WHERE common >= 0.8 * (total - common) - 1e-9),
g AS (
  SELECT s.doc_id, s.no, s.line, c.cid IS NOT NULL AND (m.cid IS NOT NULL OR c.f <> {'doc_id': s.doc_id, 'no': s.no}) AS gone
  FROM s LEFT JOIN c USING (s) LEFT JOIN m USING (cid))
SELECT d.doc_id, CAST(coalesce(k.n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.kept, '')) AS text_sha256
FROM documents d LEFT JOIN (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, string_agg(line, chr(10) ORDER BY no) FILTER (NOT gone) AS kept
  FROM g GROUP BY doc_id) k ON k.doc_id = d.doc_id
"""
