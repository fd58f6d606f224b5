"""The range-partitioned neighbour operator equals the grouped window, also
when one entity holds most rows and is cut by several range borders."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from consentflow.operators.sequence import _SEG, borders, first_following_where, last_preceding_where, segments, with_neighbour

ORDER = ["event_dttm", "event_id"]


def events(spark, n=3000, hot_share=0.7, seed=3):
    rnd = random.Random(seed)
    base = dt.datetime(2025, 1, 1)
    rows = []
    for i in range(n):
        user = "hot" if rnd.random() < hot_share else f"u{rnd.randrange(40)}"
        ts = base + dt.timedelta(seconds=rnd.randrange(0, 86400 * 5))
        if i % 97 == 0:
            ts = base  # many rows at one instant (ties broken by id)
        typ = rnd.choice(["consent.asked", "consent.given", "pageview", None])
        rows.append((user if i % 211 else None, ts if i % 89 else None, f"e{i:05d}", typ))
    return spark.createDataFrame(rows, "user_id string, event_dttm timestamp_ntz, event_id string, event_type string")


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("n,share,ranges", [(3000, 0.7, 8), (400, 1.0, 13), (300, 0.0, 4), (5, 0.5, 8)])
def test_equals_grouped_window(spark, n, share, ranges):
    df = events(spark, n, share)
    w = Window.partitionBy("user_id").orderBy(*ORDER)
    for direction, fn in (("next", F.lead), ("prev", F.lag)):
        ref = df.select("*", *[fn(c).over(w).alias(f"{c}_{direction}") for c in ("event_type", "event_dttm")])
        got = with_neighbour(df, ["user_id"], ORDER, ["event_type", "event_dttm"], direction, num_ranges=ranges)
        assert same(ref, got), direction


@pytest.mark.parametrize("share,ranges", [(0.7, 8), (1.0, 16), (0.0, 3)])
def test_first_following_equals_grouped_window(spark, share, ranges):
    df = events(spark, 1500, share)
    cond = F.col("event_type") == "consent.given"
    w = (Window.partitionBy("user_id").orderBy(*[F.col(c).desc_nulls_last() for c in ORDER])
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ref = df.select("*", F.last(F.when(cond, F.struct("event_dttm")), ignorenulls=True).over(w).getField("event_dttm").alias("g"))
    assert same(ref, first_following_where(df, ["user_id"], ORDER, "event_dttm", cond, "g", num_ranges=ranges))


@pytest.mark.parametrize("share,ranges", [(0.7, 8), (1.0, 16)])
def test_last_preceding_equals_grouped_window(spark, share, ranges):
    df = events(spark, 1500, share)
    cond = F.col("event_type") == "consent.asked"
    w = Window.partitionBy("user_id").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ref = df.select("*", F.last(F.when(cond, F.struct("event_dttm")), ignorenulls=True).over(w).getField("event_dttm").alias("g"))
    assert same(ref, last_preceding_where(df, ["user_id"], ORDER, "event_dttm", cond, "g", num_ranges=ranges))


def test_one_exchange_of_all_rows_and_nothing_written(spark):
    plan = with_neighbour(events(spark), ["user_id"], ORDER, ["event_type"])._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan.replace("Scan ExistingRDD[user_id", "") and plan.count("hashpartitioning(user_id") >= 1
    assert "rangepartitioning" not in plan and "__nb_seg" in plan


def test_borders_are_the_same_each_time_and_few(spark):
    df = events(spark, n=4000)
    found = borders(df, ["user_id"], ORDER, 8)
    keys = {r["__nb_h0"]: r["__nb_keys"] for r in found.collect()}
    assert keys == {r["__nb_h0"]: r["__nb_keys"] for r in borders(df.repartition(3), ["user_id"], ORDER, 8).collect()}
    assert set(keys) == {"hot"} and 3 <= len(keys["hot"]) <= 16
    same_instant = df.withColumn("event_dttm", F.lit(dt.datetime(2025, 1, 1)).cast("timestamp_ntz"))
    largest = segments(same_instant, ["user_id"], ORDER, 8).groupBy("user_id", _SEG).count().agg(F.max("count")).first()[0]
    assert largest < 2 * 4000 / 8


def test_no_window_group_is_much_larger_than_a_range(spark):
    df = events(spark, n=4000)
    tagged = segments(df, ["user_id"], ORDER, num_ranges=8)
    assert _SEG in tagged.columns
    largest = tagged.groupBy("user_id", _SEG).count().agg(F.max("count")).first()[0]
    assert df.where("user_id = 'hot'").count() > 2000 and largest < 2 * 4000 / 8


def test_empty_input(spark):
    df = events(spark, 3).limit(0)
    assert with_neighbour(df, ["user_id"], ORDER, ["event_type"]).count() == 0
