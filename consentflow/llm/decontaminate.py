"""Benchmark decontamination with a positional inverted index (operator 6, native).

Test items are cut into windows of ``window`` consecutive words (a shorter item
is one window). The search never compares windows with texts:

1. the training text's frequencies of all test terms are counted (partial
   aggregation; terms outside the test set are dropped inside the scan);
2. each window names its two rarest places; the training postings (text,
   position) of the terms at those places are stored -- the index;
3. postings are shifted by their place in the item, so that one occurrence of an
   item falls on one *diagonal* (position minus place); a diagonal stays if some
   window has both its rarest places on it -- the intersection of the
   offset-adjusted lists, rarest first;
4. the remaining places are checked on the texts that still have a diagonal.

``proximity_matches`` reads the same index: both rarest terms of a window
within ``near`` words of each other, in any order.

Terms reach the scan as a bitmap of ``FILTER`` hash buckets (a constant of
bounded size; strangers that share a bucket fall out of the join behind it), so
nothing that grows is broadcast by hand. Hot passages give a few rows for each
text that holds them; texts are never paired with each other.

Defined cases: null and wordless texts and items have no words, occur nowhere
and are never hit; items may repeat or share windows, and items of equal id
count once; an item with a null id hits words but is not listed; repeated rows
each give a row (texts are named by id and text fingerprint, null-safe); extra
columns are ignored; without items nothing is hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from consentflow.llm.common import drop_empty, stage, text_key

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FILTER = 1 << 16


def words_of(text: Column) -> Column:
    """Words of a text whose letters A-Z (no others) are made small."""
    text = F.coalesce(text, F.lit(""))
    # pure ASCII: lower() touches A-Z alone and is much faster
    small = F.when(F.rlike(text, F.lit(r"[^\x00-\x7F]")), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))
    return drop_empty(F.split(small, NOT_WORD))


def _bucket(term: Column) -> Column:
    return F.xxhash64(term).bitwiseAND(F.lit(FILTER - 1)).cast("int")


def _member(terms: DataFrame):
    """A test 'this term's bucket is in use': at most FILTER numbers pass the driver."""
    used = {r[0] for r in terms.select(_bucket(F.col("term"))).distinct().collect()}
    bits = F.split(F.lit(",".join("1" if b in used else "0" for b in range(FILTER))), ",").cast("array<int>")
    return lambda term: F.get(bits, _bucket(term)) == 1


def item_windows(items: DataFrame) -> DataFrame:
    """``item`` (a hash of the content), ``item_id``, ``iw`` (words), one row an item with words."""
    rows = items.select("item_id", words_of(F.col("text")).alias("iw")).where(F.size("iw") > 0)
    return rows.select(F.xxhash64("item_id", "iw").alias("item"), "item_id", "iw").dropDuplicates(["item"])


def anchors_of(items: DataFrame, frequency: DataFrame, window: int) -> DataFrame:
    """``item, pairs``: for each window that may occur its start and its two
    rarest places (the same place twice in a window of one word)."""
    size = F.least(F.size("iw"), F.lit(window))
    starts = items.select("item", F.explode(F.sequence(F.lit(0), F.size("iw") - size)).alias("start"), size.alias("size"), "iw")
    places = starts.select("item", "start", "size", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("size") - 1)
                                                             ).alias("q"), "iw")
    rated = places.select("item", "start", "size", "q", F.get("iw", "q").alias("term")).join(frequency, "term")
    best = rated.groupBy("item", "start", "size").agg(
        F.count(F.lit(1)).alias("found"), F.sort_array(F.collect_list(F.struct("df", "q", "term"))).alias("x"))
    # a window with a term that no text has cannot occur
    return best.where("found = size").select(
        "item", "start", "size", F.col("x")[0].alias("one"), F.coalesce(F.get("x", F.lit(1)), F.col("x")[0]).alias("two"))


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings (id, k, pos, term) of ``terms`` in texts ``w``, stored."""
    member = _member(terms)
    all_words = docs.select("id", "k", F.posexplode("w").alias("pos", "term"))
    found = all_words.where(member(F.col("term"))).join(terms.select("term"), "term")
    return stage(found.select("id", "k", "pos", "term"), "postings")


def _frequencies(docs: DataFrame, items: DataFrame) -> DataFrame:
    terms = items.select(F.explode("iw").alias("term")).distinct()
    member = _member(terms)
    counted = docs.select(F.explode("w").alias("term")).where(member(F.col("term"))).groupBy("term").agg(
        F.count(F.lit(1)).alias("df"))
    return stage(counted.join(terms, "term"), "frequencies")


def search(docs: DataFrame, items: DataFrame, window: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(index, anchors, diagonals): stored postings, windows' rarest places,
    and (id, k, item, diag) where some window has both of them."""
    frequency = _frequencies(docs, items)
    anchors = stage(anchors_of(items, frequency, window), "anchors")
    places = anchors.select("item", F.explode(F.array("one", "two")).alias("x")).select(
        "item", F.col("x.q").alias("q"), F.col("x.term").alias("term")).distinct()
    index = build_index(docs, places.select("term").distinct())
    aligned = index.join(places, "term").select("id", "k", "item", (F.col("pos") - F.col("q")).alias("diag"), "q")
    # one row for an occurrence, not one for each of its windows
    lists = aligned.groupBy("id", "k", "item", "diag").agg(F.collect_set("q").alias("qs"))
    # one row an item; as a stored table its size is known, so that a small one is broadcast and no item is hot
    pairs = stage(anchors.groupBy("item").agg(
        F.collect_set(F.struct(F.col("one.q").alias("a"), F.col("two.q").alias("b"))).alias("pairs")), "item-pairs")
    meet = F.exists("pairs", lambda p: F.array_contains(F.col("qs"), p.a) & F.array_contains(F.col("qs"), p.b))
    return index, anchors, stage(lists.join(pairs, "item").where(meet).select("id", "k", "item", "diag"), "diagonals")


def verify(docs: DataFrame, items: DataFrame, diagonals: DataFrame, window: int) -> DataFrame:
    """(id, k, item, diag, starts): the item's windows that occur on the
    diagonal, checked word by word on the text."""
    d = diagonals.groupBy(F.col("id").alias("id_"), F.col("k").alias("k_")).agg(F.collect_set(F.struct("item", "diag")).alias("d"))
    held = docs.join(d, docs["id"].eqNullSafe(d["id_"]) & (docs["k"] == d["k_"])).select("id", "k", words_of(F.col("t")).alias("w"), "d")
    rows = held.select("id", "k", "w", F.explode("d").alias("d")).select("id", "k", "w", "d.item", "d.diag")
    rows = rows.join(items.select("item", "iw"), "item")
    # places of the item whose word differs from the text's word there, ends included
    miss = F.filter(F.sequence(F.lit(0), F.size("iw") - 1),
                    lambda j: F.coalesce(F.when(F.col("diag") + j >= 0, F.get("w", F.col("diag") + j)), F.lit("")) != F.get("iw", j))
    missed = rows.select("id", "k", "item", "diag", F.size("iw").alias("n"), miss.alias("miss"))
    edges = missed.withColumn("edge", F.concat(F.array(F.lit(-1)), "miss", F.array("n")))
    size = F.least(F.col("n"), F.lit(window))
    runs = F.filter(F.transform(F.sequence(F.lit(0), F.size("miss")), lambda i: F.struct(
        (F.get("edge", i) + 1).alias("a"), F.get("edge", i + 1).alias("b"))), lambda r: r.b - r.a >= size)
    return edges.select("id", "k", "item", "diag", runs.alias("runs")).where(F.size("runs") > 0)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(docs[id_col].alias("id"), text_key(docs[text_col]).alias("k"), docs[text_col].alias("t"))


def _worded(docs: DataFrame) -> DataFrame:
    return docs.select("id", "k", words_of(F.col("t")).alias("w"))


def _renamed(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    return items.select(items[item_col].alias("item_id"), items[text_col].alias("text"))


def proximity_matches(index: DataFrame, anchors: DataFrame, near: int) -> DataFrame:
    """(id, k, item): some window's two rarest terms stand within ``near``
    words of each other. Positions are dealt into overlapping spans, so that
    only terms close to each other meet."""
    spans = index.select("id", "k", "term", "pos", F.explode(F.array(
        F.floor(F.col("pos") / near), F.floor(F.col("pos") / near) + 1)).alias("span"))
    wanted = anchors.where(F.col("one.q") != F.col("two.q")).select(
        "item", F.col("one.term").alias("a"), F.col("two.term").alias("b")).distinct()
    places = spans.groupBy("id", "k", "span").agg(F.collect_set(F.struct("term", "pos")).alias("there"))
    one = places.where(F.size("there") > 1).select("id", "k", "there", F.explode("there").alias("x"))
    hit = one.join(wanted, F.col("x.term") == wanted["a"]).where(F.exists("there", lambda y: (
        y.term == F.col("b")) & (y.pos != F.col("x.pos")) & (F.abs(y.pos - F.col("x.pos")) <= near)))
    return hit.select("id", "k", "item").distinct()


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, near: int = 20, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                  proximity: bool = True) -> DataFrame:
    """id, k, n_words, n_hit, items (sorted ids as text), n_near for every row of ``docs``."""
    keyed = _keyed(docs, id_col, text_col)
    worded = _worded(keyed)
    listed = stage(item_windows(_renamed(items, item_col, item_text)), "items")
    index, anchors, diagonals = search(worded, listed, window)
    found = stage(verify(keyed, listed, diagonals, window), "phrases")
    covered = F.flatten(F.transform("runs", lambda r: F.sequence(r.a + F.col("diag"), r.b + F.col("diag") - 1)))
    # rows that repeat a text give equal phrases; places and items are sets
    named = found.join(listed.select("item", F.col("item_id").cast("string").alias("item_id")), "item")
    hits = named.groupBy("id", "k").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list(covered)))).cast("long").alias("n_hit"),
        F.sort_array(F.collect_set("item_id")).alias("items"))
    out = worded.select("id", "k", F.size("w").cast("long").alias("n_words"))
    hits = hits.toDF("id_", "k_", "n_hit", "items")
    out = out.join(hits, out["id"].eqNullSafe(hits["id_"]) & (out["k"] == hits["k_"]), "left").drop("id_", "k_")
    out = out.withColumns({"n_hit": F.coalesce("n_hit", F.lit(0)), "items": F.coalesce("items", F.array().cast("array<string>"))})
    if proximity:
        close = proximity_matches(index, anchors, near).groupBy("id", "k").agg(F.count(F.lit(1)).alias("n_near")).toDF("id_", "k_", "n_near")
        out = out.join(close, out["id"].eqNullSafe(close["id_"]) & (out["k"] == close["k_"]), "left").drop("id_", "k_")
        out = out.withColumn("n_near", F.coalesce("n_near", F.lit(0)))
    return out


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), "n_near")


def remove_contaminated(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id",
                        text_col: str = "text") -> DataFrame:
    """The documents without a hit word, with their own columns."""
    keyed = _keyed(docs, id_col, text_col)
    listed = stage(item_windows(_renamed(items, "item_id", "text")), "items")
    _, _, diagonals = search(_worded(keyed), listed, window)
    bad = verify(keyed, listed, diagonals, window).select(F.col("id").alias("id_"), F.col("k").alias("k_")).distinct()
    bad = stage(bad, "contaminated")
    renamed = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    own_id, own_text = (renamed[f"c{docs.columns.index(c)}"] for c in (id_col, text_col))
    clean = renamed.join(bad, own_id.eqNullSafe(bad["id_"]) & (text_key(own_text) == bad["k_"]), "left_anti")
    return clean.toDF(*docs.columns)


ORACLE_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
b AS (
  SELECT item_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[s + 1 : s + least(len(w), 10)], ' ') AS win
  FROM (SELECT item_id, w, unnest(generate_series(0, len(w) - least(len(w), 10))) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (
  SELECT r, s, size, array_to_string(w[s + 1 : s + size], ' ') AS win
  FROM (SELECT r, w, size, unnest(generate_series(0, len(w) - size)) AS s FROM d, sizes WHERE len(w) >= size)),
hit AS (SELECT dw.r, dw.s, dw.size, bw.item_id FROM dw JOIN bw USING (size, win)),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(s, s + size - 1)) AS p FROM hit) GROUP BY r),
its AS (
  SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM hit WHERE item_id IS NOT NULL) GROUP BY r),
dt AS (SELECT r, unnest(w) AS term, unnest(range(len(w))) AS p FROM d),
bi AS (SELECT row_number() OVER () AS item, item_id, w FROM (SELECT DISTINCT item_id, w FROM b WHERE len(w) > 0)),
df AS (SELECT term, count(*) AS df FROM dt GROUP BY term),
bp AS (
  SELECT item, s, unnest(range(s, s + size)) AS q, w, size
  FROM (SELECT item, w, least(len(w), 10) AS size, unnest(generate_series(0, len(w) - least(len(w), 10))) AS s FROM bi)),
two AS (
  SELECT item, s, list({'df': df, 'q': q, 'term': term} ORDER BY df, q) AS x
  FROM (SELECT *, w[q + 1] AS term FROM bp) JOIN df USING (term) GROUP BY item, s, size HAVING count(*) = size),
want AS (SELECT DISTINCT item, x[1].term AS a, x[2].term AS b FROM two WHERE len(x) > 1),
near AS (
  SELECT x.r, count(DISTINCT item) AS n_near
  FROM want JOIN dt x ON x.term = a JOIN dt y ON y.term = b AND y.r = x.r AND y.p <> x.p AND abs(y.p - x.p) <= 20
  GROUP BY x.r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(pos.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(its.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(its.items, '')) AS items_sha256,
       coalesce(pos.n_hit, 0) > 0 AS contaminated, CAST(coalesce(near.n_near, 0) AS BIGINT) AS n_near
FROM d LEFT JOIN pos USING (r) LEFT JOIN its USING (r) LEFT JOIN near USING (r)
"""
