"""Ingestion job (MOD-12): files → raw table with lineage and a load ledger.

All new files are read in one job (one scan for each CSV header, one for the
Parquet files, unioned by name). When that job fails, one permissive pass over
the CSV files names those with records that do not parse or cast, and the others
are loaded in one more job, however many are bad; only what still fails (a broken
Parquet file, say) is found by halving. Bad files are recorded as ``failed`` and
the others still load (SRC-11). Every job is committed as a whole;
``truncate_append`` replaces the table from a staged copy and only when at least
one file loaded (trap D15). The run raises at the end if any file failed.
"""

from __future__ import annotations

import re
import secrets
import uuid
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from consentflow.operators.incremental import _hadoop, delete_path, replace_rows
from consentflow.session import scratch_path
from consentflow.sources import files as fsrc
from consentflow.sources import ledger as led
from consentflow.sources.schemas import struct_from_json_file


@dataclass
class IngestResult:
    load_no: str
    loaded: list[str] = field(default_factory=list)
    failed: list[str] = field(default_factory=list)
    skipped: int = 0


class IngestError(RuntimeError):
    pass


def infer_schema(spark: SparkSession, path: str) -> T.StructType:
    """Schema of the first file (SRC-06): a zero-row read of it."""
    return fsrc.read_any(spark, [path]).limit(0).schema


def _partitioned(df: DataFrame, partition: tuple | None) -> tuple[DataFrame, list[str]]:
    """Partition columns of a raw table: the derived one ``(name, Column)``, if
    any, and the batch id last, so a load can be removed as folders."""
    if partition is None:
        return df, ["load_no"]
    name, col = partition
    return df.withColumn(name, col), [name, "load_no"]


def _append(df: DataFrame, table_path: str, partition: tuple | None) -> None:
    """One job, committed as a whole. The rebalance hint lets AQE size the
    write tasks, so one hot partition value is split over several tasks."""
    w, by = _partitioned(df, partition)
    w.hint("rebalance", *by).write.mode("append").partitionBy(*by).parquet(table_path)


def _each(paths: list[str], load) -> tuple[list[str], list[str]]:
    """Load what can be loaded: halves of a list that failed are tried again,
    so ``k`` bad files among ``n`` cost about ``k log n`` jobs more. Returns
    (loaded, failed)."""
    try:
        load(paths)
        return paths, []
    except Exception:  # noqa: BLE001 - the file is recorded as failed
        if len(paths) == 1:
            return [], paths
    middle = len(paths) // 2
    (a, b), (c, d) = _each(paths[:middle], load), _each(paths[middle:], load)
    return a + c, b + d


def _same_path(path: str) -> str:
    return re.sub(r"^file:/+", "file:/", unquote(path))


def _load_good(spark: SparkSession, paths: list[str], schema: T.StructType, load) -> tuple[list[str], list[str]]:
    """All files in one job; if it fails, those without bad CSV records in one
    more. Returns (loaded, failed)."""
    try:
        load(paths)
        return paths, []
    except Exception:  # noqa: BLE001 - the bad files are looked for next
        if len(paths) == 1:
            return [], paths
    text = [p for p in paths if p.lower().endswith(".csv")]
    try:
        bad = {_same_path(p) for p in fsrc.bad_csv_files(spark, text, schema)} if text else set()
    except Exception:  # noqa: BLE001 - a file that no scan reads: found by halving
        bad = set()
    good, failed = ([p for p in paths if (_same_path(p) in bad) == is_bad] for is_bad in (False, True))
    loaded, more = _each(good, load) if good else ([], [])
    return loaded, sorted(failed + more)


def drop_unrecorded_loads(spark: SparkSession, table_path: str, ledger_path: str,
                          table_name: str, lease_hours: float = 0) -> list[str]:
    """Remove batches that started but never recorded an outcome (the driver
    died between the data commit and the final ledger rows): every run first
    records ``loading`` for its batch id, then ``loaded``/``failed``. Batch ids
    with ``loading`` only, for longer than ``lease_hours`` (another loader may
    be at work), have their ``load_no=<id>`` folders deleted and are marked
    ``aborted``; their files count as new again. A normal run reads only the
    (small) ledger and lists no folders."""
    ledger = led.read_ledger(spark, ledger_path).where(F.col("table_name") == table_name)
    old = F.col("load_time") <= F.current_timestamp() - F.make_dt_interval(secs=F.lit(lease_hours * 3600))
    started = ledger.where((F.col("status") == "loading") & old).select("load_no").distinct()
    ended = ledger.where(F.col("status") != "loading").select("load_no").distinct()
    open_loads = started.join(ended, "load_no", "left_anti")
    orphans = sorted(r.load_no for r in open_loads.collect())
    if not orphans:
        return []
    for load_no in orphans:
        for pattern in (f"{table_path.rstrip('/')}/load_no={load_no}", f"{table_path.rstrip('/')}/*/load_no={load_no}"):
            fs, p, _ = _hadoop(spark, pattern)
            for d in fs.globStatus(p) or []:
                fs.delete(d.getPath(), True)
    aborted = ledger.where(F.col("status") == "loading").join(open_loads, "load_no", "left_semi")
    led.append_ledger(aborted.withColumns({"status": F.lit("aborted"), "load_time": F.current_timestamp()}).select(
        *led.LEDGER_SCHEMA.names), ledger_path)
    return orphans


def ingest(spark: SparkSession, pattern: str, table_path: str, table_name: str, ledger_path: str,
           disposition: str = "append", force: bool = False, schema: T.StructType | str | None = None,
           recursive: bool = False, fail_on_error: bool = True,
           partition: tuple | None = None, lease_hours: float = 6) -> IngestResult:
    if disposition not in ("append", "truncate_append"):
        raise ValueError("disposition must be 'append' or 'truncate_append'")
    drop_unrecorded_loads(spark, table_path, ledger_path, table_name, lease_hours)
    candidates = led.list_files(spark, pattern, recursive)
    new = led.new_files(candidates, led.read_ledger(spark, ledger_path), table_name, force)
    # the paths (one row per new file) go to the driver: the reader takes a list
    new_list = [(r.filename, r.modification_time, r.length)
                for r in new.orderBy("filename").collect()]
    n_candidates = candidates.count()
    if n_candidates == 0:
        raise FileNotFoundError(f"no files found for pattern: {pattern}")
    # the letter keeps partition discovery from reading an id as a number
    result = IngestResult(load_no=f"L{secrets.token_hex(6)}", skipped=n_candidates - len(new_list))
    if not new_list:
        return result
    paths = [f for f, _, _ in new_list]
    if isinstance(schema, str):
        schema = struct_from_json_file(schema)
    if schema is None:
        schema = infer_schema(spark, paths[0])
    led.append_ledger(led.ledger_rows(spark, new_list, table_name, result.load_no,
                                      {p: "loading" for p in paths}), ledger_path)

    def rows(some: list[str]) -> DataFrame:
        return fsrc.read_any(spark, some, schema, result.load_no)

    if disposition == "append":
        result.loaded, result.failed = _load_good(spark, paths, schema, lambda some: _append(rows(some), table_path, partition))
    else:
        # good files are staged first; the table changes only if there are any
        parts: list[str] = []

        def put_aside(some: list[str]) -> None:
            path = scratch_path(spark, f"stage/load-{uuid.uuid4().hex[:12]}")
            rows(some).write.mode("errorifexists").parquet(path)
            parts.append(path)
        try:
            result.loaded, result.failed = _load_good(spark, paths, schema, put_aside)
            if parts:
                df, by = _partitioned(spark.read.parquet(*parts), partition)
                replace_rows(df, table_path, by)
        finally:
            for path in parts:
                delete_path(spark, path)
    status = {p: "failed" for p in result.failed} | {p: "loaded" for p in result.loaded}
    led.append_ledger(led.ledger_rows(spark, new_list, table_name, result.load_no, status), ledger_path)
    if result.failed and fail_on_error:
        raise IngestError(f"{len(result.failed)} file(s) failed to load: {result.failed}")
    return result
