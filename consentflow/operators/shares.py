"""Distribution shares: a measure per (entity, category) over the entity total."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def share_by(df: DataFrame, entity: list[str], category: list[str], measure, name: str,
             share_name: str | None = None) -> DataFrame:
    """Sum ``measure`` per entity × category, then divide by the entity total.

    The total is a window over the *aggregated* rows (one row per category),
    so the window partitions are tiny no matter how skewed the raw entity is;
    the heavy lifting is the partial/final hash aggregate.
    """
    m = F.col(measure) if isinstance(measure, str) else measure
    agg = df.groupBy(*entity, *category).agg(F.sum(m).alias(name))
    total = F.sum(name).over(Window.partitionBy(*entity))
    return agg.withColumn(share_name or f"{name}_share", F.col(name) / total)
