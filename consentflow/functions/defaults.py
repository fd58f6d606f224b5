"""Default members, validity bounds and other constants of the model."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

# Fixed values. These must equal the values the modelled warehouse uses, so
# that keys, default rows, filters and labels give identical results.
DEFAULT_STRING = "n/a"
DEFAULT_INT = 0
DATE_MIN = _dt.date(1900, 1, 1)
TS_MIN = _dt.datetime(1900, 1, 1)
TS_MAX = _dt.datetime(9999, 12, 31)
SURROGATE_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SURROGATE_JOINER = "-"
DATE_SPINE_START = _dt.date(2000, 1, 1)
DATE_SPINE_END = _dt.date(2100, 12, 31)
PAGEVIEW = "pageview"
CONSENT_ASKED = "consent.asked"
CONSENT_GIVEN = "consent.given"
UI_ACTION = "ui.action"
CONSENT_STATUSES = ("full opt-in", "opt-out", "partial opt-in", "empty")
ORIGIN_CONSENT = "fct_event"
ORIGIN_REPORT = "fct_consent"
ORIGIN_SEED = "seed"


def default_string():
    return F.lit(DEFAULT_STRING)


def default_int():
    return F.lit(DEFAULT_INT)


def _ntz(value: _dt.datetime):
    """A timestamp_ntz literal from its text (no session time zone involved)."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def ts_min():
    return _ntz(TS_MIN)


def ts_max():
    return _ntz(TS_MAX)


def date_min():
    return F.lit(DATE_MIN)


def null_timestamp():
    """Untyped ``null`` of the source models, typed (trap D22)."""
    return F.lit(None).cast("timestamp_ntz")


__all__ = [n for n in dir() if n.isupper() or n in (
    "default_string", "default_int", "ts_min", "ts_max", "date_min", "null_timestamp")]
