"""Load windows: the [start, end] day range an incremental run processes."""

from __future__ import annotations

import datetime as _dt
import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

_PLAIN_DATE = re.compile(r"^\d{4}-\d{2}-\d{2}$")


def resolve_bound(value) -> Column:
    """A window bound as a date Column.

    ``datetime.date`` / plain ``YYYY-MM-DD`` text → date literal; text with a
    space or a parenthesis → SQL expression (e.g. ``current_date - 1``);
    a Column is used as is. Anything else is rejected instead of being
    wrapped into a failing date parse (trap D1).
    """
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        return F.lit(value.date())
    if isinstance(value, _dt.date):
        return F.lit(value)
    text = str(value).strip()
    if _PLAIN_DATE.match(text):
        return F.to_date(F.lit(text), "yyyy-MM-dd")
    if text.lower() in ("current_date", "today"):
        return F.current_date()
    if " " in text or "(" in text:
        return F.expr(text).cast("date")
    raise ValueError(f"cannot interpret window bound {value!r}")


@dataclass(frozen=True)
class LoadWindow:
    """Inclusive day range. Defaults: yesterday → today."""

    start: object = "current_date() - 1"
    end: object = "current_date()"

    def start_col(self) -> Column:
        return resolve_bound(self.start)

    def end_col(self) -> Column:
        return resolve_bound(self.end)

    def on_timestamp(self, col) -> Column:
        """Whole days: ``start <= ts < end + 1 day`` (trap D2: a timestamp
        compared with ``<= end`` would keep only midnight of the end day).
        Written as a range on the raw column so it reaches the Parquet scan."""
        c = F.col(col) if isinstance(col, str) else col
        lo = self.start_col().cast("timestamp_ntz")
        hi = F.date_add(self.end_col(), 1).cast("timestamp_ntz")
        return (c >= lo) & (c < hi)

    def on_date(self, col) -> Column:
        c = F.col(col) if isinstance(col, str) else col
        return (c >= self.start_col()) & (c <= self.end_col())


def apply(df, window: LoadWindow | None, col: str, kind: str = "timestamp"):
    """Filter ``df`` to the window; no window = first/full load (no filter)."""
    if window is None:
        return df
    pred = window.on_timestamp(col) if kind == "timestamp" else window.on_date(col)
    return df.where(pred)
