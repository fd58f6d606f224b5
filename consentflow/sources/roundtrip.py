"""File round trips of the raw events: export as CSV + Parquet, load back.

Used by the ingestion queries: the raw events derived from the driver tables
are written the way upstream systems deliver them (CSV with quoted JSON and
triple-quoted country codes for the consent types, Parquet for the others),
then loaded through the ledger-driven ingest or the streaming file source.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from consentflow.operators.incremental import delete_path
from consentflow.session import scratch_path
from consentflow.sources import ingest as ing
from consentflow.sources.schemas import RAW_EVENT_COLUMNS, RAW_EVENT_SCHEMA
from consentflow.streaming import file_stream

CSV_TYPES = ("pageview", "consent.asked")
# keep microseconds in CSV text (the lenient default parser reads it back)
CSV_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

RAW_NAMES = [n for n, _ in RAW_EVENT_COLUMNS]


def export_raw(raw: DataFrame, out_dir: str, names: list[str] | None = None) -> tuple[str, str]:
    """Write raw events: CSV for asked/pageview rows, Parquet for the rest;
    the columns in the order of ``names``."""
    body = raw.select(*(names or RAW_NAMES))
    is_csv = F.col("TYPE").isin(*CSV_TYPES)
    csv_dir, pq_dir = f"{out_dir}/csv", f"{out_dir}/parquet"
    (body.where(is_csv).write.mode("errorifexists").option("header", True)
     .option("escape", '"').option("timestampNTZFormat", CSV_TS_FORMAT).csv(csv_dir))
    body.where(~is_csv | F.col("TYPE").isNull()).write.mode("errorifexists").parquet(pq_dir)
    return csv_dir, pq_dir


def ingest_roundtrip(spark: SparkSession, raw: DataFrame) -> DataFrame:
    """Files whose CSV headers differ in order, and one that cannot be read:
    the others load, by name, and once."""
    base = scratch_path(spark, f"roundtrip/ingest-{uuid.uuid4().hex[:10]}")
    try:
        export_raw(raw.where(F.crc32(F.col("EVENT_ID")) % 2 == 0), f"{base}/in/a")
        export_raw(raw.where((F.crc32(F.col("EVENT_ID")) % 2 != 0) | F.col("EVENT_ID").isNull()), f"{base}/in/b", list(reversed(RAW_NAMES)))
        spark.range(1).select(F.lit("not a number").alias("RATE")).write.option("header", True).csv(f"{base}/in/c/csv")
        table, ledger = f"{base}/raw_events", f"{base}/_ledger"
        first = ing.ingest(spark, f"{base}/in/*/*/part-*", table, "events", ledger, schema=RAW_EVENT_SCHEMA, fail_on_error=False)
        if len(first.failed) != 1:
            raise AssertionError(f"one file cannot be read, found {first.failed}")
        # a second run finds every other file in the ledger and loads nothing
        again = ing.ingest(spark, f"{base}/in/*/*/part-*", table, "events", ledger, schema=RAW_EVENT_SCHEMA, fail_on_error=False)
        if again.loaded:
            raise AssertionError("the ledger should make the second load a no-op")
        return spark.read.parquet(table).checkpoint()
    finally:
        delete_path(spark, base)


def stream_roundtrip(spark: SparkSession, raw: DataFrame) -> DataFrame:
    base = scratch_path(spark, f"roundtrip/stream-{uuid.uuid4().hex[:10]}")
    try:
        raw.select(*RAW_NAMES).write.mode("errorifexists").parquet(f"{base}/in")
        target, ckpt = f"{base}/raw_events", f"{base}/_checkpoint"
        file_stream.stream_ingest(spark, f"{base}/in", RAW_EVENT_SCHEMA, target, ckpt)
        return spark.read.parquet(target).checkpoint()
    finally:
        delete_path(spark, base)


def stream_consent_roundtrip(spark: SparkSession, raw: DataFrame, files: int = 4) -> DataFrame:
    """Raw event files of no order in time → micro-batches of one file each →
    company × day fact. Days come back in many micro-batches."""
    base = scratch_path(spark, f"roundtrip/stream-consent-{uuid.uuid4().hex[:10]}")
    try:
        raw.select(*RAW_NAMES).repartition(files, F.crc32(F.col("EVENT_ID"))).write.mode("errorifexists").parquet(f"{base}/in")
        target, ckpt = f"{base}/fct_consent", f"{base}/_checkpoint"
        file_stream.stream_consent_daily(spark, f"{base}/in", RAW_EVENT_SCHEMA, target, ckpt, max_files_per_trigger=1)
        return spark.read.parquet(target).checkpoint()
    finally:
        delete_path(spark, base)
