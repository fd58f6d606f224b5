"""Salted join and as-of lookup against plain joins and brute force."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from consentflow.operators.as_of import as_of
from consentflow.operators.salted_join import hot_keys, salted_join


def facts(spark, n=6000, share=0.6, seed=5):
    rnd = random.Random(seed)
    rows = [(i, "hot" if rnd.random() < share else rnd.choice([None, *[f"k{j}" for j in range(30)]])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, k string")


def dims(spark):
    rows = [("hot", 1), ("hot", 2), *[(f"k{j}", j) for j in range(0, 30, 2)], (None, 7), ("unused", 8)]
    return spark.createDataFrame(rows, "k string, v int")


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(spark, how):
    f, d = facts(spark), dims(spark)
    got = salted_join(f, d, "k", ["id"], how, ranges=8)
    assert got.columns == ["id", "k", "v"]
    assert same(got, f.join(d, "k", how).select("id", "k", "v"))
    empty = f.limit(0)
    assert salted_join(empty, d, "k", ["id"], how).count() == 0
    assert same(salted_join(f, d.limit(0), "k", ["id"], how), f.join(d.limit(0), "k", how).select("id", "k", "v"))


def test_salted_join_spreads_a_hot_key(spark):
    """One key with 60 % of the rows (and null with some) in shuffled joins."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    f = facts(spark, 20_000)
    d = dims(spark).where("v <> 2")
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)

        def sizes(j):
            return [r["count"] for r in j.groupBy(F.spark_partition_id()).count().collect()]
        salted, plain = sizes(salted_join(f, d, "k", ["id"])), sizes(f.join(d, "k", "left"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert max(plain) > 0.6 * 20_000
    assert len(salted) == 8 and max(salted) <= 2 * statistics.median(salted)


def test_hot_keys_are_bounded(spark):
    f = spark.range(20_000).selectExpr("id", "CAST(id % 5000 AS string) AS k")
    assert hot_keys(f, "k", 8).count() == 0
    assert hot_keys(facts(spark), "k", 8).agg(F.sum("__sj_salts")).first()[0] <= 2 * 8 * 16


def by_hand(rows, versions):
    out = []
    for i, k, t in rows:
        held = [(lo, hi is not None, hi, v) for kk, lo, hi, v in versions if k is not None and kk == k and t is not None and lo is not None and lo <= t]
        best = max(held, key=lambda x: (x[0], x[1], x[2] or dt.datetime.min, x[3]), default=None)
        out.append((i, k, t, best[3] if best and best[2] is not None and t <= best[2] else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("share,ranges", [(0.9, 8), (0.0, 3), (1.0, 16)])
def test_as_of_by_hand(spark, share, ranges):
    rnd = random.Random(int(share * 10) + ranges)
    base = dt.datetime(2024, 1, 1)

    def when(steps=200):
        return base + dt.timedelta(hours=rnd.randrange(steps))
    rows = [(i, "hot" if rnd.random() < share else rnd.choice(["a", "b", "none", None]), None if i % 53 == 0 else when()) for i in range(1500)]
    versions = [(k, lo, rnd.choice([lo + dt.timedelta(hours=rnd.randrange(60)), dt.datetime(9000, 1, 1), None]), f"v{n}")
                for n, (k, lo) in enumerate((rnd.choice(["hot", "a", "b", None]), when()) for _ in range(60))]
    versions += [("hot", versions[0][1], dt.datetime(9000, 1, 1), "tie"), ("a", None, dt.datetime(9000, 1, 1), "no start")]
    f = spark.createDataFrame(rows, "id long, k string, at timestamp_ntz")
    d = spark.createDataFrame(versions, "k string, valid_from timestamp_ntz, valid_to timestamp_ntz, v string")
    got = as_of(f, d, "k", "at", ["v"], "id", num_ranges=ranges)
    assert got.columns == ["id", "k", "at", "v"]
    assert sorted(map(tuple, got.collect()), key=str) == by_hand(rows, versions)


def test_as_of_without_versions_or_rows(spark):
    f = spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 1))], "id long, k string, at timestamp_ntz")
    d = spark.createDataFrame([], "k string, valid_from timestamp_ntz, valid_to timestamp_ntz, v string")
    assert [tuple(r) for r in as_of(f, d, "k", "at", ["v"], "id").collect()] == [(1, "a", dt.datetime(2024, 1, 1), None)]
    assert as_of(f.limit(0), d, "k", "at", ["v"], "id").count() == 0
