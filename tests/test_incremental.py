"""Key-replace semantics, schema drift, idempotence, backfill splits, and
overwrites that break off at any step."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from consentflow.operators import incremental
from consentflow.operators.window_bounds import LoadWindow
from consentflow.plans import staging
from consentflow.plans.graph import ModelGraph
from consentflow.warehouse import PartitionedTable
from tests.conftest import SF_SMALL


def test_delete_insert_replaces_keys_and_keeps_batch_duplicates(spark):
    target = spark.createDataFrame([("k1", 1), ("k2", 2), ("k3", 3)], "k string, v int")
    batch = spark.createDataFrame([("k2", 20), ("k4", 40), ("k4", 41)], "k string, v int")
    out = sorted(tuple(r) for r in incremental.delete_insert(target, batch, ["k"]).collect())
    assert out == [("k1", 1), ("k2", 20), ("k3", 3), ("k4", 40), ("k4", 41)]
    # uniqueness guard (D7) surfaces the batch duplicate
    assert [tuple(r) for r in incremental.duplicate_keys(batch, ["k"]).collect()] == [("k4", 2)]


def test_append_new_columns(spark):
    target = spark.createDataFrame([("k1", 1)], "k string, v int")
    batch = spark.createDataFrame([("k2", 2, "new")], "k string, v int, extra string")
    rows = {r.k: r for r in incremental.append_new_columns(target, batch).collect()}
    assert rows["k1"].extra is None and rows["k2"].extra == "new"


def test_key_replace_is_idempotent_and_backfill_split_equals_full(spark):
    g = ModelGraph(spark, SF_SMALL)
    full = staging.stg_consent(g.fct_event).drop("run_id", "ingest_dttm")
    # load the month in three backfill windows, the middle one twice
    parts = [LoadWindow(dt.date(2024, 1, 1), dt.date(2024, 1, 10)),
             LoadWindow(dt.date(2024, 1, 11), dt.date(2024, 1, 20)),
             LoadWindow(dt.date(2024, 1, 11), dt.date(2024, 1, 20)),
             LoadWindow(dt.date(2024, 1, 21), dt.date(2024, 1, 31))]
    acc = None
    for w in parts:
        batch = staging.stg_consent(g.fct_event, w).drop("run_id", "ingest_dttm")
        acc = batch if acc is None else incremental.delete_insert(acc, batch, ["consent_uq"])
    assert acc.count() == full.count()
    assert acc.exceptAll(full).count() == 0 and full.exceptAll(acc).count() == 0


def rows_of(spark, path):
    return sorted((tuple(r) for r in spark.read.parquet(path).collect()), key=str)


def test_dynamic_partition_replace(spark, tmp_dir):
    path = f"{tmp_dir}/consent"
    d1, d2 = dt.date(2025, 1, 1), dt.date(2025, 1, 2)
    ddl = "k string, v int, event_dt date"
    incremental.replace_rows(spark.createDataFrame([("a", 1, d1), ("b", 2, d2), ("c", 3, None)], ddl), path, ["event_dt"])
    incremental.replace_rows(spark.createDataFrame([("b", 20, d2)], ddl), path, ["event_dt"], dynamic=True)
    assert rows_of(spark, path) == [("a", 1, d1), ("b", 20, d2), ("c", 3, None)]


def test_failed_computation_leaves_the_table(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    incremental.replace_rows(spark.createDataFrame([("a", 1)], "k string, v int"), path)
    bad = spark.createDataFrame([("x",)], "k string").select("k", F.col("k").cast("int").alias("v"))
    with pytest.raises(Exception):
        incremental.replace_rows(bad, path)
    assert rows_of(spark, path) == [("a", 1)]
    assert incremental.recover(spark, path) == 0


@pytest.mark.parametrize("dynamic", [True, False])
def test_broken_swap_is_finished_from_the_copy(spark, tmp_dir, monkeypatch, dynamic):
    """The overwrite deletes and then breaks off: no row is lost."""
    path = f"{tmp_dir}/t"
    d1, d2 = dt.date(2025, 1, 1), dt.date(2025, 1, 2)
    ddl = "k string, v int, d date"
    table = PartitionedTable(spark, path, "d")
    table.overwrite(spark.createDataFrame([("a", 1, d1), ("b", 2, d2)], ddl))
    real = incremental._swap

    def breaks(spark_, plan):
        incremental.delete_path(spark_, f"{path}/d={d2}")
        raise RuntimeError("driver lost")
    monkeypatch.setattr(incremental, "_swap", breaks)
    batch = spark.createDataFrame([("b", 20, d2), ("c", 30, d2)], ddl)
    with pytest.raises(RuntimeError):
        table.key_replace(batch, ["k"]) if dynamic else incremental.replace_rows(batch, path, ["d"])
    monkeypatch.setattr(incremental, "_swap", real)
    assert incremental.recover(spark, path, min_age_s=3600) == 0  # a writer may still be at work
    assert table.exists()  # the next writer finishes it
    want = [("b", 20, d2), ("c", 30, d2)]
    assert rows_of(spark, path) == ([("a", 1, d1)] if dynamic else []) + want
    assert incremental.recover(spark, path) == 0


def test_key_replace_covers_null_and_default_partitions(spark, tmp_dir):
    d0, d1 = dt.date(1900, 1, 1), dt.date(2025, 1, 1)
    ddl = "k string, v int, d date"
    table = PartitionedTable(spark, f"{tmp_dir}/t", "d")
    table.overwrite(spark.createDataFrame([("a", 1, None), ("b", 1, None), ("c", 1, d0), ("e", 1, d1)], ddl))
    table.key_replace(spark.createDataFrame([("b", 2, None), ("f", 2, d0)], ddl), ["k"])
    assert sorted((r.k, r.v) for r in table.read().collect()) == [("a", 1), ("b", 2), ("c", 1), ("e", 1), ("f", 2)]
    table.key_replace(spark.createDataFrame([], ddl), ["k"])
    assert table.read().count() == 5


def test_kept_schema_reads_new_columns_as_null(spark, tmp_dir):
    d1, d2 = dt.date(2025, 1, 1), dt.date(2025, 1, 2)
    table = PartitionedTable(spark, f"{tmp_dir}/t", "d")
    table.overwrite(spark.createDataFrame([("a", 1, d1)], "k string, v int, d date"))
    table.key_replace(spark.createDataFrame([("b", 2, d2, "new")], "k string, v int, d date, extra string"), ["k"])
    rows = {r.k: r for r in table.read().collect()}
    assert rows["a"].extra is None and rows["b"].extra == "new"
