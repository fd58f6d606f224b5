"""Surrogate keys: md5 over the '-'-joined text of the key fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from consentflow.functions.defaults import SURROGATE_JOINER, SURROGATE_NULL_TOKEN


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*fields) -> Column:
    """md5 hex of the fields cast to text, nulls replaced by a token.

    Dates render as ``yyyy-MM-dd`` in Spark and in SQL engines alike, so keys
    built on a day are stable across engines (fact → dimension late binding).
    """
    parts = [F.coalesce(_as_col(f).cast("string"), F.lit(SURROGATE_NULL_TOKEN)) for f in fields]
    text = parts[0] if len(parts) == 1 else F.concat_ws(SURROGATE_JOINER, *parts)
    return F.md5(text)


def random_id() -> Column:
    """A random (version 4) UUID for each row, as text."""
    return F.expr("uuid()")
