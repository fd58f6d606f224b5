"""Type changes of known columns."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from consentflow.operators.widening import merged_schema, reads_as, wider
from consentflow.warehouse import PartitionedTable

LADDER = ["tinyint", "smallint", "int", "bigint", "decimal(12,2)", "decimal(38,10)", "float", "double"]
NAMED = {"tinyint": T.ByteType(), "smallint": T.ShortType(), "int": T.IntegerType(), "bigint": T.LongType(), "float": T.FloatType(),
         "double": T.DoubleType(), "date": T.DateType(), "timestamp_ntz": T.TimestampNTZType(), "string": T.StringType()}


def of(name):
    if name.startswith("decimal"):
        return T.DecimalType(*map(int, name[8:-1].split(",")))
    return NAMED[name]


def one(name):
    return T.StructType([T.StructField("c", of(name))])


def test_lattice():
    for a, b in itertools.product(LADDER, repeat=2):
        w = wider(of(a), of(b))
        assert w == wider(of(b), of(a)) and wider(w, of(a)) == w  # commutes, holds both
    assert wider(of("int"), of("decimal(12,2)")) == of("decimal(12,2)")
    assert wider(of("bigint"), of("decimal(12,2)")) == of("decimal(22,2)")
    assert wider(of("date"), of("timestamp_ntz")) == of("timestamp_ntz")
    assert wider(of("string"), of("int")) is None
    with pytest.raises(TypeError, match="'c'"):
        merged_schema(one("string"), one("int"))


@pytest.mark.parametrize("a,b", [(a, b) for a, b in itertools.permutations(LADDER, 2) if wider(of(a), of(b)) == of(b)])
def test_reader_widens_what_is_said(spark, tmp_dir, a, b):
    if not reads_as(of(a), of(b)):
        pytest.skip("rewritten")
    spark.range(3).select(F.col("id").cast(a).alias("c")).write.parquet(f"{tmp_dir}/t")
    got = spark.read.schema(one(b)).parquet(f"{tmp_dir}/t")
    assert sorted(float(r.c) for r in got.collect()) == [0, 1, 2]


@pytest.mark.parametrize("first,then,value", [("int", "bigint", 1 << 40), ("bigint", "double", 0.25), ("int", "double", 0.25),
                                              ("decimal(6,2)", "double", 1e30), ("int", "decimal(14,2)", 7), ("bigint", "int", 7)])
def test_table_keeps_both(spark, tmp_dir, first, then, value):
    t = PartitionedTable(spark, f"{tmp_dir}/t", "d")
    day = dt.date(2024, 1, 1)

    def batch(ids, kind, v, shift):
        return spark.createDataFrame([(i, day + dt.timedelta(days=shift + i)) for i in ids], "k int, d date").select(
            "k", "d", F.lit(v).cast(kind).alias("v"))
    t.overwrite(batch(range(4), first, 5, 0))
    t.key_replace(batch([2, 3, 9], then, value, 0), ["k"])
    want = wider(of(first), of(then))
    got = t.read()
    assert got.schema["v"].dataType == want
    assert {r.k: float(r.v) for r in got.collect()} == {0: 5, 1: 5, 2: value, 3: value, 9: value}
    t.partition_replace(batch([50], first, 6, 0))  # narrow rows into a wide table
    assert t.read().schema["v"].dataType == want and t.read().count() == 6
    with pytest.raises(TypeError, match="'v'"):
        t.key_replace(batch([1], "string", "x", 0), ["k"])
    assert t.read().count() == 6
