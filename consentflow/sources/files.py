"""File scans: CSV / Parquet events, company CSV, country seed, lineage columns."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from consentflow.sources.schemas import COUNTRY_SEED_SCHEMA, LINEAGE_COLUMNS, RAW_COMPANY_SCHEMA


def expand(spark: SparkSession, paths) -> list[str]:
    """Files behind paths, globs and folders."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for path in [paths] if isinstance(paths, str) else list(paths):
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        found = list(fs.globStatus(p) or [])
        if not found:
            raise FileNotFoundError(path)
        for s in found:
            inside = fs.listStatus(s.getPath()) if s.isDirectory() else [s]
            out += [str(f.getPath()) for f in inside if f.isFile() and not f.getPath().getName().startswith(("_", "."))]
    return out


def header_of(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The column names in a CSV file's first line (nothing else is read)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    opened = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration()).getCodec(p)
    stream = codec.createInputStream(opened) if codec is not None else opened
    try:
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        opened.close()
    return tuple(next(csv.reader([line]), ())) if line else ()


def header_groups(spark: SparkSession, paths, threads: int = 16) -> list[list[str]]:
    """Files by equal header: Spark's reader takes the header of one file for
    all the files of a scan, so files that differ need scans of their own."""
    groups = files_by_header(spark, paths, threads)
    return [groups[h] for h in sorted(groups)]


def files_by_header(spark: SparkSession, paths, threads: int = 16) -> dict[tuple[str, ...], list[str]]:
    files = expand(spark, paths)
    with ThreadPoolExecutor(max_workers=threads) as pool:
        headers = list(pool.map(lambda f: header_of(spark, f), files))
    groups: dict[tuple, list[str]] = {}
    for f, h in zip(files, headers):
        groups.setdefault(h, []).append(f)
    return groups


def csv_scans(spark: SparkSession, paths, schema: T.StructType | None = None) -> list[DataFrame]:
    """One scan for each header among event CSVs: quoted multi-line JSON with
    doubled quotes.

    ``escape='"'`` is required: with the default backslash escape a field such
    as ``"{""a"": 1}"`` is split. With a ``schema`` the columns are matched by
    their header *names* (a user schema on the CSV reader would be applied by
    position): fields are read as text and cast to the schema's types, absent
    ones are null (trap D13). Under ANSI a value that does not cast fails the
    job, so the loader records the file as failed. ``inferSchema`` only when no
    schema is given (reads the data twice). A file is one task: a quoted field
    may hold line feeds."""
    r = (spark.read.option("header", True).option("multiLine", True)
         .option("escape", '"').option("quote", '"').option("mode", "FAILFAST"))
    if schema is None:
        return [r.option("inferSchema", True).csv(g) for g in header_groups(spark, paths)]
    return [by_name(r.csv(g), schema) for g in header_groups(spark, paths)]  # every column read as text


CORRUPT = "__corrupt"


def bad_csv_files(spark: SparkSession, paths, schema: T.StructType) -> list[str]:
    """Files with a record that ``csv_scans`` would fail on: one that does not
    parse (it lands in the corrupt-record column of a permissive scan) or a value
    that does not cast. One job over all files, aggregated by file in the tasks;
    only the bad files' names reach the driver."""
    found = []
    for header, group in files_by_header(spark, paths).items():
        names = list(header)
        if len({n.lower() for n in names}) < len(names) or not names:
            continue  # no scan by name: such a file shows when it is loaded alone
        text = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
        r = (spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("quote", '"')
             .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).schema(text))
        bad = F.col(CORRUPT).isNotNull()
        for f in schema.fields:
            if f.name in names and not isinstance(f.dataType, T.StringType):
                bad = bad | ((F.col(f.name) != "") & F.col(f.name).try_cast(f.dataType).isNull())
        # all columns are named, so that no field is skipped by the parser
        found.append(r.csv(group).select(F.col("_metadata.file_path").alias("file"), F.coalesce(bad, F.lit(False)).alias("bad"),
                                         F.hash(*names).alias("read")).where(F.col("bad") & F.col("read").isNotNull()))
    if not found:
        return []
    return sorted(r.file for r in _union([f.select("file") for f in found]).distinct().collect())


def _union(parts: list[DataFrame]) -> DataFrame:
    if not parts:
        raise ValueError("no input files")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def read_events_csv(spark: SparkSession, paths, schema: T.StructType | None = None) -> DataFrame:
    """Event CSVs, columns matched by name across files (see ``csv_scans``)."""
    return _union(csv_scans(spark, paths, schema))


def by_name(text: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast text columns to ``schema`` by column name. An empty text in a
    non-string column is null (as a typed CSV read would give); absent
    columns are null."""
    present = set(text.columns)
    cols = []
    for f in schema.fields:
        if f.name not in present:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = F.col(f.name)
        if not isinstance(f.dataType, T.StringType):
            c = F.when(c != "", c)
        cols.append(c.cast(f.dataType).alias(f.name))
    return text.select(*cols)


def read_events_parquet(spark: SparkSession, paths, schema: T.StructType | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(*([paths] if isinstance(paths, str) else paths))


def read_any(spark: SparkSession, paths, schema: T.StructType | None = None,
             load_no: str | None = None) -> DataFrame:
    """CSV and/or Parquet by extension, unioned by column name (SRC-15).
    With ``load_no`` the lineage columns are attached to each scan before the
    union (the file-name metadata column exists only on a scan)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if schema is not None and load_no is not None:  # the load itself adds these
        added = {n.lower() for n, _ in LINEAGE_COLUMNS}
        schema = T.StructType([f for f in schema.fields if f.name.lower() not in added])
    text = [p for p in paths if p.lower().endswith(".csv")]
    pq = [p for p in paths if not p.lower().endswith(".csv")]
    parts = csv_scans(spark, text, schema) if text else []
    if pq:
        parts.append(read_events_parquet(spark, pq, schema))
    if load_no is not None:
        parts = [with_lineage(p, load_no) for p in parts]
    return _union(parts)


def with_lineage(df: DataFrame, load_no: str) -> DataFrame:
    """Add ``load_time`` (now), ``load_no`` (batch id) and ``filename`` (the
    base name of the file each row came from, from the scan's metadata)."""
    return df.select("*", F.current_timestamp().alias("load_time"), F.lit(load_no).alias("load_no"),
                     F.col("_metadata.file_name").alias("filename"))


def read_company_csv(spark: SparkSession, paths) -> DataFrame:
    """Company reference CSV, columns matched by header name."""
    r = spark.read.option("header", True).option("escape", '"')
    return _union([by_name(r.csv(g), RAW_COMPANY_SCHEMA) for g in header_groups(spark, paths)])


def read_country_seed(spark: SparkSession, path: str) -> DataFrame:
    """Seed CSV: 'NA' stays a string (no null-value mapping), "" becomes null,
    numeric codes with leading zeros parse as integers."""
    return spark.read.option("header", True).schema(COUNTRY_SEED_SCHEMA).csv(path)


def describe(df: DataFrame) -> DataFrame:
    """Column name / type listing of a scan (SRC-22)."""
    spark = df.sparkSession
    return spark.createDataFrame([(f.name, f.dataType.simpleString(), f.nullable)
                                  for f in df.schema.fields],
                                 "column_name string, column_type string, nullable boolean")


def empty_like(df: DataFrame) -> DataFrame:
    """Schema-only clone (SRC-24, LIM-02)."""
    return df.limit(0)


def synthetic_rows(spark: SparkSession, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows: id, three uniform doubles, md5 of a random number, random
    int in [0, 1000) (SRC-26). Generated in parallel by ``spark.range``."""
    return spark.range(n).select(
        F.col("id"),
        F.rand(seed).alias("col_a"), F.rand(seed + 1).alias("col_b"), F.rand(seed + 2).alias("col_c"),
        F.md5(F.rand(seed + 3).cast("string")).alias("col_d"),
        (F.rand(seed + 4) * 1000).cast("int").alias("col_e"))


def export_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """``COPY (SELECT ...) TO file`` (SRC-23)."""
    df.write.mode("overwrite").option("header", header).option("escape", '"').csv(path)
