"""As-of lookup: the version of a member that was valid at a row's own time.

Versions and rows are merged into one sequence per key in order of time (a
version before the rows of its instant); every row takes the last version at or
before it, and drops it where its validity has ended. That is one exchange of
rows and versions on the sequence operator's ranges, so a key with a third of all
rows is split by time like any hot entity, and no row meets more than one version
-- an interval join would pair each row with every version of its key.

Of versions of one key that start at one instant, the one that ends last is
taken (then the greatest by its columns). Null keys and null times match nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from consentflow.operators.sequence import last_preceding_where


def as_of(rows: DataFrame, versions: DataFrame, key: str, time: str, cols: list[str], unique: str,
          valid_from: str = "valid_from", valid_to: str = "valid_to", num_ranges: int | None = None) -> DataFrame:
    """``rows`` and the ``cols`` of the version of ``key`` with ``valid_from <=
    time <= valid_to`` (nulls where there is none); ``unique`` orders the rows
    of an instant."""
    kind = rows.schema[time].dataType
    named = [F.col(c).alias(f"__ao_r{i}") for i, c in enumerate(rows.columns)]
    member = F.struct(F.col(valid_to).cast(kind).alias("to"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(cols)])
    row, version = F.struct(*named), versions.select(
        F.col(key).alias("__ao_key"), F.col(valid_from).cast(kind).alias("__ao_time"), member.alias("__ao_member"))
    version = version.where(F.col("__ao_key").isNotNull() & F.col("__ao_time").isNotNull()).groupBy("__ao_key", "__ao_time").agg(
        F.max("__ao_member").alias("__ao_member"))
    fact = rows.select(F.col(key).alias("__ao_key"), F.col(time).alias("__ao_time"), F.lit(1).alias("__ao_kind"),
                       F.col(unique).cast("string").alias("__ao_unique"), row.alias("__ao_row"))
    merged = fact.unionByName(version.withColumns({"__ao_kind": F.lit(0), "__ao_unique": F.lit("")}), allowMissingColumns=True)
    found = last_preceding_where(merged, ["__ao_key"], ["__ao_time", "__ao_kind", "__ao_unique"], "__ao_member",
                                 F.col("__ao_kind") == 0, "__ao_found", num_ranges)
    valid = F.col("__ao_key").isNotNull() & (F.col("__ao_time") <= F.col("__ao_found.to"))

    def value(i: int) -> Column:
        return F.when(valid, F.col("__ao_found").getField(f"v{i}"))
    return found.where(F.col("__ao_kind") == 1).select(
        *[F.col("__ao_row").getField(f"__ao_r{i}").alias(c) for i, c in enumerate(rows.columns)],
        *[value(i).alias(c) for i, c in enumerate(cols)])
