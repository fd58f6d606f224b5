import datetime as dt
import hashlib

from pyspark.sql import functions as F

from consentflow.functions import (
    conversion_rate, extrapolated_count, seconds_between, strip_quotes, surrogate_key)
from consentflow.functions.defaults import SURROGATE_NULL_TOKEN


def md5(s):
    return hashlib.md5(s.encode()).hexdigest()


def test_surrogate_key_single_and_multi(spark):
    df = spark.createDataFrame([("c1", dt.date(2025, 9, 5)), (None, None)], "c string, d date")
    rows = df.select(surrogate_key("c").alias("k1"), surrogate_key("c", "d").alias("k2")).collect()
    assert rows[0].k1 == md5("c1")
    assert rows[0].k2 == md5("c1-2025-09-05")
    assert rows[1].k1 == md5(SURROGATE_NULL_TOKEN)
    assert rows[1].k2 == md5(f"{SURROGATE_NULL_TOKEN}-{SURROGATE_NULL_TOKEN}")


def test_extrapolation_rounds_half_even(spark):
    df = spark.createDataFrame([(1, 0.4), (3, 0.4), (5, 0.4), (10, 0.1), (7, 1.0)], "c long, r double")
    got = [r[0] for r in df.select(extrapolated_count("c", "r")).collect()]
    assert got == [2.0, 8.0, 12.0, 100.0, 7.0]  # 2.5→2, 7.5→8, 12.5→12


def test_zero_rate_fails_fast(spark):
    """A zero sampling rate must fail the job (ANSI division), not yield inf."""
    import pytest
    df = spark.createDataFrame([(1, 0.0)], "c long, r double")
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        df.select(extrapolated_count("c", "r")).collect()


def test_conversion_rate_exact_half_up(spark):
    df = spark.createDataFrame([(29.0, 200.0), (1.0, 1.0), (1.0, 3.0), (None, 5.0), (5.0, None),
                                (1.0, 200.0)], "g double, a double")
    got = [r[0] for r in df.select(conversion_rate("g", "a")).collect()]
    assert [None if x is None else float(x) for x in got] == [0.15, 1.0, 0.33, None, None, 0.01]


def test_seconds_between_floors(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 5, 1, 10, 0, 0), dt.datetime(2025, 5, 1, 10, 2, 0, 900000))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert df.select(seconds_between("a", "b")).first()[0] == 120


def test_strip_quotes(spark):
    df = spark.createDataFrame([('"ES"',), ('ES',), ('""FR""',)], "c string")
    assert [r[0] for r in df.select(strip_quotes("c")).collect()] == ["ES", "ES", "FR"]
    _ = F


def test_gap_is_wall_clock_in_any_session_zone(spark):
    """timestamp_ntz gaps do not depend on the session time zone (DST)."""
    tz = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30), dt.datetime(2024, 3, 10, 3, 10))],
                                   "a timestamp_ntz, b timestamp_ntz")
        r = df.select(seconds_between("a", "b").alias("s")).first()
        assert r.s == 2400
    finally:
        spark.conf.set("spark.sql.session.timeZone", tz)
