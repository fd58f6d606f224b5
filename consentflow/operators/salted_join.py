"""Left or inner join to a dimension when few keys hold most rows.

The rows of one key meet in one task of a shuffled join: a company with 60 % of
the events becomes 60 % of the job. Here the key frequencies are counted first
(a partial aggregate: one row a key leaves each task). A key with more than
1 / ``PIECES`` of a task's share of the rows is *hot* and gets as many salts as
it has such parts. Its fact rows draw a salt from the hash of ``spread`` -- a
unique column, so a retried task draws the same -- and its dimension rows are
repeated once a salt. All others have the salt 0. The join runs on (key, salt),
so a task's rows do not depend on the keys' frequencies.

Bounds: there are at most ``ranges * PIECES`` hot keys and twice as many salts,
and the table of hot keys is broadcast with that bound. The join itself has no
hint: a small dimension is still broadcast by its size.

Null keys match nothing; in a left join their rows are spread like any hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECES = 16


def hot_keys(facts: DataFrame, key: str, ranges: int) -> DataFrame:
    """``__sj_key`` and its number of salts, of the keys above the bound."""
    rows = facts.agg(F.count(F.lit(1))).scalar()
    part = F.greatest(F.lit(1.0), rows / F.lit(ranges * PIECES))
    counts = facts.groupBy(F.col(key).alias("__sj_key")).agg(F.count(F.lit(1)).alias("__sj_n"))
    return counts.where(F.col("__sj_n") > part).select("__sj_key", F.ceil(F.col("__sj_n") / part).cast("int").alias("__sj_salts"))


def salted_join(facts: DataFrame, dim: DataFrame, key: str, spread: list[str], how: str = "left",
                ranges: int | None = None) -> DataFrame:
    """``facts`` joined with ``dim`` on ``key`` (the name in both): the columns
    of ``facts``, then those of ``dim`` without the key."""
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    hot = F.broadcast(hot_keys(facts, key, ranges or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    salt = F.coalesce(F.pmod(F.xxhash64(*[facts[c] for c in spread]), F.col("__sj_salts")).cast("int"), F.lit(0))
    left = facts.join(hot, facts[key].eqNullSafe(hot["__sj_key"]), "left").select(*[facts[c] for c in facts.columns], salt.alias("__sj_salt"))
    salts = F.sequence(F.lit(0), F.coalesce("__sj_salts", F.lit(1)) - 1)
    names = {c: f"__sj_d{i}" for i, c in enumerate(dim.columns)}
    named = dim.select(*[F.col(c).alias(a) for c, a in names.items()])
    right = named.join(hot, named[names[key]] == hot["__sj_key"], "left").select(*names.values(), F.explode(salts).alias("__sj_s"))
    j = left.join(right, (left[key] == right[names[key]]) & (left["__sj_salt"] == right["__sj_s"]), how)
    return j.select(*[left[c] for c in facts.columns], *[right[a].alias(c) for c, a in names.items() if c != key])
