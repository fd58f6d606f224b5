"""Neighbour-in-sequence operator (lead / lag per entity in time order).

``with_neighbour`` adds, for every row, columns of the next (or previous) row
of the same entity (``by``) in ``order``; ``first_following_where`` the first
later row that meets a condition. Callers pass a unique column (the event id)
last in ``order`` so ties are broken deterministically.

Skew. The textbook form, ``lead(c) over (partition by user order by ts)``,
sends every row of one user to one task: a user holding a third of all rows
becomes a third of the job in one task. There is one plan for all sizes:

1. *Borders as a value.* Of the keys (entity, order) those are drawn whose hash
   says so, about ``SAMPLES`` for each of ``n`` ranges; every ``SAMPLES``-th drawn
   key of an entity is a border. Only entities with more than a range's share of
   the rows get any, about ``n`` in all: a small table, broadcast with that bound.
   It depends on the keys alone, so every branch of the plan and every retried
   task computes the same one; nothing is written and no job runs beforehand.
2. A row's number ``seg`` is how many borders of its entity are not behind it, by
   binary search in a column expression. The window runs over (entity, seg): the
   only exchange of all rows, and never many more rows than a range has.
3. Stitch: only an entity with borders has several groups. Their first (or last)
   rows are taken from a partial aggregate over these entities and joined back --
   broadcast, one row a border.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SEG = "__nb_seg"
SAMPLES = 64  # drawn keys a range: a range's size is right to about 1 / 8


def _null_safe_on(left: DataFrame, right: DataFrame, pairs):
    cond = None
    for lc, rc in pairs:
        c = left[lc].eqNullSafe(right[rc])
        cond = c if cond is None else cond & c
    return cond


def _ranges(df: DataFrame, num_ranges: int | None) -> int:
    return num_ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def borders(df: DataFrame, by: list[str], order: list[str], num_ranges: int | None = None) -> DataFrame:
    """Entities (``__nb_h0``...) with their sorted border keys (step 1)."""
    rows = df.agg(F.count(F.lit(1))).scalar()
    every = F.greatest(F.lit(1).cast("long"), F.floor(rows / F.lit(SAMPLES * _ranges(df, num_ranges))))
    names = _aliases(by)
    drawn = (df.where(F.pmod(F.xxhash64(*by, *order), every) == 0)
             .groupBy(*[F.col(c).alias(a) for c, a in zip(by, names)], F.struct(*order).alias("__nb_key"))
             .agg(F.count(F.lit(1)).alias("__nb_n")))
    upto = F.sum("__nb_n").over(Window.partitionBy(*names).orderBy("__nb_key"))
    step = drawn.withColumn("__nb_upto", upto).where(
        F.floor(F.col("__nb_upto") / SAMPLES) > F.floor((F.col("__nb_upto") - F.col("__nb_n")) / SAMPLES))
    return step.groupBy(*names).agg(F.sort_array(F.collect_list("__nb_key")).alias("__nb_keys"))


def _not_behind(keys: Column, key: Column, ranges: int) -> Column:
    """How many of the sorted ``keys`` are at most ``key``: a binary search, the
    steps being falling powers of two."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range((4 * ranges).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= F.size(keys)) & (F.get(keys, at + step - 1) <= key), at + step).otherwise(at))


def _tagged(df: DataFrame, found: DataFrame, by: list[str], order: list[str], num_ranges: int | None, how: str) -> DataFrame:
    j = df.join(F.broadcast(found), _null_safe_on(df, found, zip(by, _aliases(by))), how)
    seg = F.when(F.col("__nb_keys").isNull(), 0).otherwise(
        _not_behind(F.col("__nb_keys"), F.struct(*[df[c] for c in order]), _ranges(df, num_ranges)))
    return j.select(*[df[c] for c in df.columns], seg.alias(_SEG))


def segments(df: DataFrame, by: list[str], order: list[str], num_ranges: int | None = None) -> DataFrame:
    """``df`` plus ``__nb_seg``, the number of the row's range in its entity."""
    return _tagged(df, borders(df, by, order, num_ranges), by, order, num_ranges, "left")


def _aliases(by: list[str]) -> list[str]:
    return [f"__nb_h{i}" for i in range(len(by))]


def _across(groups: DataFrame, by: list[str], value: Column, later: bool) -> DataFrame:
    """For (entity, seg) groups that have another group after them (``later``)
    or before them: ``__nb_there`` = ``value`` over those, nearest first. At
    most one row a range border."""
    there = F.lead if later else F.lag
    order = Window.partitionBy(*by).orderBy(_SEG)
    rest = order.rowsBetween(1, Window.unboundedFollowing) if later else order.rowsBetween(Window.unboundedPreceding, -1)
    pick = F.first if later else F.last
    named = groups.select(*[F.col(c).alias(a) for c, a in zip(by, _aliases(by))], F.col(_SEG).alias("__nb_s"),
                          there(F.lit(True)).over(order).alias("__nb_more"),
                          pick(value, ignorenulls=True).over(rest).alias("__nb_there"))
    return F.broadcast(named.where("__nb_more").drop("__nb_more"))


def with_neighbour(df: DataFrame, by: list[str], order: list[str], cols: list[str],
                   direction: str = "next", suffix: str | None = None,
                   num_ranges: int | None = None) -> DataFrame:
    """Add ``<col><suffix>`` = value of ``col`` in the next/previous row of the
    same ``by`` group ordered by ``order`` (null when there is none)."""
    if direction not in ("next", "prev"):
        raise ValueError("direction must be 'next' or 'prev'")
    later = direction == "next"
    suffix = suffix or ("_next" if later else "_prev")
    found = borders(df, by, order, num_ranges)
    tagged, cut = (_tagged(df, found, by, order, num_ranges, how) for how in ("left", "inner"))

    payload = F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(cols)])
    inside = Window.partitionBy(*by, _SEG).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    x = tagged.withColumn("__nb_in", (F.lead if later else F.lag)(payload).over(inside))

    key = F.struct(*[F.col(c) for c in order])
    edge = cut.groupBy(*by, _SEG).agg((F.min_by if later else F.max_by)(payload, key).alias("__nb_edge"))
    there = _across(edge, by, F.col("__nb_edge"), later)
    j = x.join(there, _null_safe_on(x, there, [*zip(by, _aliases(by)), (_SEG, "__nb_s")]), "left")
    value = F.coalesce("__nb_in", "__nb_there")
    return j.select(*[x[c] for c in df.columns],
                    *[value.getField(f"v{i}").alias(f"{c}{suffix}") for i, c in enumerate(cols)])


def _nearest_where(df: DataFrame, by: list[str], order: list[str], value: str, cond: Column, alias: str,
                   num_ranges: int | None, later: bool) -> DataFrame:
    """Inside a range a running ``last(.., ignorenulls)``, for later rows in
    *descending* order (a running frame, not an unbounded-following one); rows
    without a match there take the nearest match of the entity's other ranges."""
    found = borders(df, by, order, num_ranges)
    tagged, cut = (_tagged(df, found, by, order, num_ranges, how) for how in ("left", "inner"))
    hit = F.when(cond, F.struct(F.col(value).alias("v")))
    towards = [F.col(c).desc_nulls_last() if later else F.col(c).asc_nulls_first() for c in order]
    running = Window.partitionBy(*by, _SEG).orderBy(*towards).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = tagged.withColumn("__nb_in", F.last(hit, ignorenulls=True).over(running))

    key = F.struct(*[F.col(c) for c in order])
    nearest = F.when(cond, F.struct(key.alias("k"), F.col(value).alias("v")))
    groups = cut.groupBy(*by, _SEG).agg((F.min if later else F.max)(nearest).alias("__nb_hit"))
    value_there = F.when(F.col("__nb_hit").isNotNull(), F.struct(F.col("__nb_hit.v").alias("v")))
    there = _across(groups, by, value_there, later)
    j = x.join(there, _null_safe_on(x, there, [*zip(by, _aliases(by)), (_SEG, "__nb_s")]), "left")
    return j.select(*[x[c] for c in df.columns], F.coalesce("__nb_in", "__nb_there").getField("v").alias(alias))


def first_following_where(df: DataFrame, by: list[str], order: list[str], value: str,
                          cond: Column, alias: str, num_ranges: int | None = None) -> DataFrame:
    """Add ``alias`` = ``value`` of the first row at or after the current one
    (same entity, in ``order``) for which ``cond`` holds."""
    return _nearest_where(df, by, order, value, cond, alias, num_ranges, later=True)


def last_preceding_where(df: DataFrame, by: list[str], order: list[str], value: str,
                         cond: Column, alias: str, num_ranges: int | None = None) -> DataFrame:
    """Add ``alias`` = ``value`` of the last row at or before the current one
    (same entity, in ``order``) for which ``cond`` holds."""
    return _nearest_where(df, by, order, value, cond, alias, num_ranges, later=False)
