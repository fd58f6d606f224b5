"""Metric expressions: extrapolation, conversion rate, elapsed seconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extrapolated_count(count="count", rate="rate") -> Column:
    """``round(count / rate)`` with round-half-even on a double.

    A SQL ``round`` of a double rounds half to even in the source warehouse;
    Spark's ``round`` is half-up, ``rint`` is half-even. A zero rate raises
    under ANSI mode (the intended fail-fast, trap D9).
    """
    return F.rint(_c(count) / _c(rate))


def conversion_rate(given, asked, scale: int = 2) -> Column:
    """given / asked as exact decimal, rounded half-up to ``scale`` digits.

    Operands are cast to decimal(20,0): decimal(38,18) operands would fall to
    scale 6 and round twice (trap D8b). Null when either side is null; ANSI
    raises on asked = 0 like the numeric division it models.
    """
    dec = "decimal(20,0)"
    return F.round(_c(given).cast(dec) / _c(asked).cast(dec), scale)


def _gap_seconds(start, end) -> Column:
    """Exact elapsed seconds (decimal, 6 places) as ``end - start``.

    Subtracting two timestamps yields a day-time interval; for
    ``timestamp_ntz`` that is the wall-clock gap, independent of the session
    time zone (``timestampdiff`` converts through the session zone and is off
    by the DST shift across a transition)."""
    return (_c(end) - _c(start)).cast("interval second").cast("decimal(38,6)")


def micros_between(start, end) -> Column:
    """Elapsed microseconds from ``start`` to ``end``."""
    return (_gap_seconds(start, end) * 1_000_000).cast("long")


def seconds_between(start, end) -> Column:
    """Whole seconds from ``start`` to ``end`` (floor of the epoch of the gap)."""
    return F.floor(_gap_seconds(start, end)).cast("long")


def hour_start(c) -> Column:
    """Start of the hour of a ``timestamp_ntz`` from its own fields (no
    session time zone involved, unlike ``date_trunc``)."""
    col = _c(c)
    return F.make_timestamp_ntz(F.year(col), F.month(col), F.dayofmonth(col), F.hour(col),
                                F.lit(0), F.lit(0))


def strip_quotes(c) -> Column:
    """Remove the literal double quotes wrapped around country/region codes."""
    return F.btrim(_c(c), F.lit('"'))
