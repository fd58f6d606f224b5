"""Key-replace (delete+insert) increments, schema drift and durable writes.

A batch replaces every target row whose unique key occurs in the batch; the
batch itself is inserted whole (duplicates inside a batch are not removed,
use ``duplicate_keys`` as a guard).
"""

from __future__ import annotations

import json
import time
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from consentflow.session import scratch_path


def delete_insert(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows whose key is not in the batch, plus the whole batch.

    The anti join shuffles on the key; the batch keys are de-duplicated first
    (``distinct`` is a partial aggregate), so a hot key cannot fan out. New
    batch columns are appended, absent ones are null (append_new_columns)."""
    batch_keys = batch.select(*keys).distinct()
    kept = target.join(batch_keys, keys, "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


def append_new_columns(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Union by name; columns missing on either side become null (INC-02)."""
    return target.unionByName(batch, allowMissingColumns=True)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Uniqueness guard (INC-07): keys occurring more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") > 1)


# --------------------------------------------------------------------------- durable tables
#
# A Parquet folder is never overwritten from the job that computes the new
# rows. They are written to a staged copy in the shared folder first; a marker
# beside the table then records the copy, the table is overwritten from it, and
# only after that the marker and the copy go. A failure while the rows are
# computed leaves the table as it was; a failure inside the overwrite leaves the
# marker, and the next reader or writer finishes it from the copy (``recover``).

def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _hadoop(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p, _ = _hadoop(spark, path)
    fs.delete(p, True)


def _marker_dir(path: str) -> str:
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_pending_{name}"


def _put(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file and give it its name in one step."""
    fs, p, jvm = _hadoop(spark, path)
    temporary = jvm.org.apache.hadoop.fs.Path(f"{path}.tmp")
    out = fs.create(temporary, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(temporary, p):
        raise OSError(f"cannot name {path}")


def _swap(spark: SparkSession, plan: dict) -> None:
    df = spark.read.parquet(plan["staged"])
    if plan["partition_by"]:
        # rebalance: AQE sizes the write tasks by volume, splitting a hot day
        df = df.hint("rebalance", *plan["partition_by"])
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", plan["mode"])
    if plan["partition_by"]:
        writer = writer.partitionBy(*plan["partition_by"])
    writer.parquet(plan["path"])


READ_LEASE_S = 3600


def recover(spark: SparkSession, path: str, min_age_s: float = 0) -> int:
    """Finish overwrites of ``path`` that broke off; how many there were. A
    table has one writer at a time, which recovers at once; readers leave
    markers younger than ``min_age_s`` to a writer that may be at work."""
    folder = _marker_dir(path)
    fs, p, jvm = _hadoop(spark, folder)
    if not fs.exists(p):
        return 0
    markers = sorted(str(s.getPath()) for s in fs.listStatus(p) if s.getPath().getName().endswith(".json")
                     and time.time() - s.getModificationTime() / 1000 >= min_age_s)
    for marker in markers:
        lines = spark.read.text(marker).collect()  # one line
        plan = json.loads(lines[0][0])
        _swap(spark, plan)
        delete_path(spark, marker)
        delete_path(spark, plan["staged"])
    return len(markers)


def replace_rows(df: DataFrame, path: str, partition_by: list[str] | None = None, dynamic: bool = False) -> None:
    """Overwrite the table at ``path`` (only the partitions in ``df`` when
    ``dynamic``) so that no failure loses rows. ``df`` may read the table."""
    spark = df.sparkSession
    recover(spark, path)
    staged_path = scratch_path(spark, f"stage/replace-{uuid.uuid4().hex[:12]}")
    try:
        df.write.mode("errorifexists").parquet(staged_path)
    except BaseException:
        delete_path(spark, staged_path)
        raise
    plan = {"path": path, "staged": staged_path, "partition_by": partition_by or [],
            "mode": "dynamic" if dynamic else "static"}
    marker = f"{_marker_dir(path)}/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}.json"
    _put(spark, marker, json.dumps(plan))
    _swap(spark, plan)  # after a failure here the marker and the copy stay
    delete_path(spark, marker)
    delete_path(spark, staged_path)


@contextmanager
def staged(df: DataFrame, name: str):
    """``df`` written to the shared folder for the duration of a block."""
    spark = df.sparkSession
    path = scratch_path(spark, f"stage/{name}-{uuid.uuid4().hex[:8]}")
    try:
        df.write.mode("errorifexists").parquet(path)
        yield spark.read.parquet(path)
    finally:
        delete_path(spark, path)
