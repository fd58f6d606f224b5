"""Load ledger: which files were loaded into which table, and when.

The ledger is a small Parquet table (one row per file and load attempt). New
files are the candidates minus those already ``loaded`` for the target table,
matched on path *and* modification time and size, so a modified file is
picked up again (trap D14). ``failed`` attempts do not count as loaded, so
they are retried on the next run.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from consentflow.operators.incremental import path_exists
from consentflow.sources.schemas import LEDGER_SCHEMA

FILE_KEY = ["filename", "modification_time", "length"]


def list_files(spark: SparkSession, pattern: str, recursive: bool = False) -> DataFrame:
    """Files matching a glob (SRC-03/21): path, modification time, size.

    Uses the binary-file source with the content column pruned, so only the
    file listing is touched; the listing itself is distributed by Spark."""
    r = spark.read.format("binaryFile")
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    files = r.load(pattern).select(
        F.col("path").alias("filename"),
        F.col("modificationTime").alias("modification_time"),
        F.col("length"))
    return files


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger; empty when there is none yet. Any other error is one."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def current_rows(rows: DataFrame, ledger: DataFrame, table_name: str) -> DataFrame:
    """``rows`` without those of superseded loads: a file that changed is loaded
    anew (other time or size) and its earlier load no longer counts. Rows carry
    the file's base name and load number; only loads of changed files take part,
    so the anti join's right side holds as many rows as files were replaced."""
    done = ledger.where((F.col("status") == "loaded") & (F.col("table_name") == table_name))
    newest = done.groupBy("filename").agg(F.max(F.struct("load_time", "load_no")).alias("last"))
    old = done.join(newest, "filename").where(F.col("load_no") != F.col("last.load_no")).select(
        F.element_at(F.split("filename", "/"), -1).alias("__file"), F.col("load_no").alias("__load")).distinct()
    return rows.join(old, (rows["filename"] == old["__file"]) & (rows["load_no"] == old["__load"]), "left_anti")


def new_files(candidates: DataFrame, ledger: DataFrame, table_name: str,
              force: bool = False) -> DataFrame:
    """Candidates not yet loaded into ``table_name`` (SRC-09, SET-04); all of
    them when ``force`` (SRC-14). EXCEPT semantics: distinct rows."""
    cand = candidates.select(*FILE_KEY).distinct()
    if force:
        return cand
    loaded = ledger.where((F.col("status") == "loaded") & (F.col("table_name") == table_name)) \
        .select(*FILE_KEY)
    return cand.join(loaded, FILE_KEY, "left_anti")


def ledger_rows(spark: SparkSession, files: list[tuple], table_name: str, load_no: str,
                status: dict[str, str]) -> DataFrame:
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    rows = [(f, table_name, status[f], now, load_no, mt, ln) for f, mt, ln in files]
    return spark.createDataFrame(rows, LEDGER_SCHEMA)


def append_ledger(df: DataFrame, path: str) -> None:
    """SRC-10: append this run's per-file rows."""
    df.write.mode("append").parquet(path)
