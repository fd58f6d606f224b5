"""Exactly-once file pick-up (STR-01) and micro-batch key-replace (STR-02).

The file source's checkpoint plays the role of the load ledger: each file is
committed to exactly one micro-batch, a rerun picks up only files it has not
seen. ``trigger(availableNow=True)`` processes what is there and stops, which
fits a scheduled batch job; a long-running query uses ``processingTime``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from consentflow.operators.incremental import path_exists
from consentflow.plans import mart, staging


def read_event_files(spark: SparkSession, source_dir: str, schema: T.StructType,
                     fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        r = r.option("header", True).option("multiLine", True).option("escape", '"')
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(source_dir)


def stream_ingest(spark: SparkSession, source_dir: str, schema: T.StructType, target_path: str,
                  checkpoint: str, fmt: str = "parquet", load_no: str = "stream") -> int:
    """Append new files of ``source_dir`` to ``target_path`` with lineage
    columns; returns the number of micro-batches run."""
    src = read_event_files(spark, source_dir, schema, fmt)
    out = src.select("*", F.current_timestamp().alias("load_time"), F.lit(load_no).alias("load_no"),
                     F.col("_metadata.file_name").alias("filename"))
    q = (out.writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start(target_path))
    q.awaitTermination()
    return len(q.recentProgress)


def stream_upsert_events(spark: SparkSession, source_dir: str, schema: T.StructType,
                         table_path: str, checkpoint: str, fmt: str = "parquet",
                         max_files_per_trigger: int | None = None) -> int:
    """Each micro-batch of raw events is staged and key-replaced into the
    event fact (``foreachBatch`` + delete+insert), partitioned by event day:
    only the days present in the micro-batch are read and rewritten. A
    replayed batch (after a failure) replaces the same keys again, so the
    result is idempotent."""
    from consentflow.warehouse import PartitionedTable  # avoid an import cycle

    table = PartitionedTable(spark, table_path, "event_dt")
    src = read_event_files(spark, source_dir, schema, fmt, max_files_per_trigger).select(
        "*", F.col("_metadata.file_name").alias("filename"))

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        raw = batch.select(*[c for c in batch.columns if c != "filename"],
                           F.current_timestamp().alias("load_time"),
                           F.lit(f"epoch-{epoch_id}").alias("load_no"), "filename")
        fct = mart.fct_event(staging.stg_event(raw)).withColumn("event_dt", F.to_date("event_dttm"))
        table.key_replace(fct, ["event_uq"])

    q = (src.writeStream.option("checkpointLocation", checkpoint).foreachBatch(upsert)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(q.recentProgress)


def stream_consent_daily(spark: SparkSession, source_dir: str, schema: T.StructType,
                         table_path: str, checkpoint: str, fmt: str = "parquet",
                         max_files_per_trigger: int | None = None) -> int:
    """Company × day consent fact kept up to date from a stream of raw files.

    Events may come late by any time, repeat, or have no event time: nothing is
    held against a watermark. Each micro-batch's events go to an event store
    beside the fact, partitioned by event day and micro-batch (a replayed
    micro-batch replaces its own folders), and their company × day sums to a
    table of totals of the same partitions. The days that a micro-batch touches
    -- the null day too -- are added up anew from the totals and replaced in the
    fact. A micro-batch reads its own events and the totals of its days, never
    the events of earlier ones (once, where a store has no totals yet)."""
    from consentflow.warehouse import PartitionedTable  # avoid an import cycle

    fact = PartitionedTable(spark, table_path, "event_dt")
    store, totals = f"{table_path.rstrip('/')}_events", f"{table_path.rstrip('/')}_totals"
    src = read_event_files(spark, source_dir, schema, fmt, max_files_per_trigger).select(
        "*", F.col("_metadata.file_name").alias("filename"))

    def put(df: DataFrame, path: str) -> DataFrame:
        (df.hint("rebalance", "event_dt").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("event_dt", "epoch").parquet(path))
        return spark.read.schema(df.schema).parquet(path)

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        own = F.col("epoch") == f"e{epoch_id}"
        raw = batch.select(*[c for c in batch.columns if c != "filename"],
                           F.current_timestamp().alias("load_time"), F.lit(f"epoch-{epoch_id}").alias("load_no"), "filename")
        events = mart.fct_event(staging.stg_event(raw)).withColumns(
            {"event_dt": F.to_date("event_dttm"), "epoch": F.lit(f"e{epoch_id}")})
        stored = put(events, store)
        # a store of an older layout has no totals: they are made of all its events
        new = stored.where(own) if path_exists(spark, f"{totals}/_SUCCESS") else stored
        sums = put(new.groupBy("company_id", "event_dt", "epoch").agg(*staging.consent_measures()), totals)
        days = [r[0] for r in sums.where(own).select("event_dt").distinct().collect()]  # one row a day
        if not days:
            return
        here = F.col("event_dt").isin([d for d in days if d is not None])
        if None in days:
            here = here | F.col("event_dt").isNull()
        fact.partition_replace(mart.fct_consent(staging.key_consent(staging.merge_consent(sums.where(here)))))

    q = (src.writeStream.option("checkpointLocation", checkpoint).foreachBatch(upsert)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(q.recentProgress)
