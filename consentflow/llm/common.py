"""Shared helpers of the training-data operators."""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from consentflow.session import checkpoint_dir, scratch_path

# Rows and bytes of one Arrow batch handed to Python: long texts must not pile
# up in a worker, whatever the number of rows.
ARROW_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the Python workers (once an application), so that
    they need no copy of the repository on their path."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="consentflow-code-"), "consentflow_code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, files in os.walk(package):
            for f in files:
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session, name the shared folder and
    send the code to the workers."""
    for k, v in ARROW_CONF.items():
        spark.conf.set(k, v)
    checkpoint_dir(spark)
    ship_code(spark)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Larger Arrow batches for jobs over narrow rows that run inside."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: lineage
    ends here, and lost executors re-read files instead of recomputing; ``options``
    are those of the writer.

    The shuffle files of the job are of no use after it. Spark deletes them once
    the driver's garbage is collected, which is asked for here, so that a chain
    of stages holds the disk of one of them."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}")
    df.write.options(**options).parquet(path)
    for _ in range(2):  # what the first round lets go of, the second collects
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)
    return spark.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Delete the folder of a staged table that no later step reads."""
    spark = df.sparkSession
    for f in {os.path.dirname(x) for x in df.inputFiles()}:
        if "/llm/" in f:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that no column of ``df`` has (names compare caseless)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def text_key(text: Column) -> Column:
    """64-bit fingerprint of a text; with the id it names a row's content, so
    repeated ids with different texts stay apart. A null text counts as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def null_safe(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> Column:
    cond = left[cols[0]].eqNullSafe(right[cols[0]])
    for c in cols[1:]:
        cond = cond & left[c].eqNullSafe(right[c])
    return cond


def drop_empty(words: Column) -> Column:
    return F.array_remove(words, "")


def sha256_hex(data: Column) -> Column:
    return F.sha2(data.cast("binary"), 256)
