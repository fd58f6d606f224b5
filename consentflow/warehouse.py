"""Warehouse lifecycle: load raw files, build the layers, run the checks.

Layout (one folder per layer, SRC-19)::

    <root>/raw/events/                    append-only raw events (+ lineage)
    <root>/raw/country_and_industry/      company reference
    <root>/raw/countries/                 country seed
    <root>/raw/_ledger/                   load ledger
    <root>/mart/dim_company|dim_country|dim_date/      full rebuild per run
    <root>/mart/fct_event/event_dt=.../   key-replaced per batch
    <root>/mart/fct_consent/event_dt=.../ key-replaced per batch
    <root>/report/consent_company_day/date_day=.../

Incremental runs (INC-01..06): the staging models are functions of the load
window (not persisted, trap D16); each fact receives only the batch. Every
key in the facts embeds the day (``event_uq = md5(event_id-day)``,
``consent_uq = md5(company-day)``), so a batch can only replace rows of the
days it contains: only those partitions are read (static partition filter
on the batch's days), merged and rewritten (dynamic partition overwrite,
INC-08). Every overwrite goes through a staged copy and a marker
(``incremental.replace_rows``), so no failure leaves a table without its rows.
"""

from __future__ import annotations

import json
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from consentflow.operators import incremental, widening
from consentflow.operators.window_bounds import LoadWindow
from consentflow.plans import checks, mart, report, staging
from consentflow.sources import files, ingest as ing, ledger as led

RAW_EVENT_DATE = "EVENT_DATE"


class DataCheckError(AssertionError):
    """A data check returned violating rows."""


class PartitionedTable:
    """A Parquet table partitioned by one date column with key replacement
    restricted to the partitions present in a batch."""

    def __init__(self, spark: SparkSession, path: str, partition_col: str):
        self.spark, self.path, self.partition_col = spark, path.rstrip("/"), partition_col

    @property
    def _schema_path(self) -> str:
        parent, _, name = self.path.rpartition("/")
        return f"{parent}/_schema_{name}"

    def exists(self) -> bool:
        incremental.recover(self.spark, self.path)
        return incremental.path_exists(self.spark, self.path)

    def schema(self) -> T.StructType | None:
        """The table's columns, kept beside it by every write: reading needs
        no file footer, whatever the number of days."""
        if not incremental.path_exists(self.spark, self._schema_path):
            return None
        lines = self.spark.read.text(self._schema_path).orderBy("value").collect()  # one per write that added a column
        return T.StructType.fromJson(json.loads(lines[-1][0].split("\t", 1)[1]))

    def _keep_schema(self, schema: T.StructType, replace: bool) -> None:
        known = None if replace else self.schema()
        if known is None or schema != known:
            incremental._put(self.spark, f"{self._schema_path}/{time.time_ns():020d}.txt", f"{time.time_ns():020d}\t{schema.json()}")

    def _widened(self, batch: DataFrame) -> DataFrame:
        """``batch`` in the table's types, after the table's were widened to hold
        the batch's. Stored files are widened as they are read; a change that the
        reader does not know (bigint to double) rewrites the table once."""
        known = self.schema()
        if known is None:  # a table of an older layout
            known = self.read().schema
        found = widening.merged_schema(known, batch.schema)
        wanted = {f.name: f.dataType for f in found.fields}
        if not all(widening.reads_as(f.dataType, wanted[f.name]) for f in known.fields):
            incremental.replace_rows(widening.cast_to(self.read(), found), self.path, [self.partition_col])
        self._keep_schema(found, replace=False)
        return widening.cast_to(batch, found)

    def read(self) -> DataFrame:
        """Partitions written before a model gained a column lack it
        (append_new_columns, INC-02): the kept schema reads them as null, and
        columns of a narrower type as the table's."""
        incremental.recover(self.spark, self.path, incremental.READ_LEASE_S)
        schema = self.schema()
        if schema is None:  # a table of an older layout
            return self.spark.read.option("mergeSchema", "true").parquet(self.path)
        return self.spark.read.schema(schema).parquet(self.path)

    def overwrite(self, df: DataFrame) -> None:
        """Full refresh (INC-05): the whole table is replaced."""
        incremental.replace_rows(df, self.path, [self.partition_col])
        self._keep_schema(T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields]), replace=True)

    def key_replace(self, batch: DataFrame, keys: list[str]) -> None:
        """Replace the rows of ``batch``'s keys, touching only its partitions.

        The batch is staged once and its distinct partition values -- one per
        day, the null day too -- select the partitions statically, so the scan
        lists and reads only those folders."""
        if not self.exists():
            self.overwrite(batch)  # first run: the batch is the table (INC-04)
            return
        with incremental.staged(batch, "batch") as batch:
            days = [r[0] for r in batch.select(self.partition_col).distinct().collect()]
            if not days:
                return
            col = F.col(self.partition_col)
            here = col.isin([d for d in days if d is not None])
            if None in days:
                here = here | col.isNull()
            batch = self._widened(batch)
            merged = incremental.delete_insert(self.read().where(here), batch, keys)
            incremental.replace_rows(merged, self.path, [self.partition_col], dynamic=True)

    def partition_replace(self, df: DataFrame) -> None:
        """Replace whole partitions by the rows of ``df``."""
        if not self.exists():
            self.overwrite(df)
            return
        incremental.replace_rows(self._widened(df), self.path, [self.partition_col], dynamic=True)


@dataclass
class Warehouse:
    spark: SparkSession
    root: str
    violations: dict[str, int] = field(default_factory=dict)  # of the report rows that the last build wrote

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def read(self, layer: str, name: str) -> DataFrame:
        """``ref()`` / ``source()`` (SRC-18)."""
        incremental.recover(self.spark, self.path(layer, name), incremental.READ_LEASE_S)
        return self.spark.read.parquet(self.path(layer, name))

    # ----------------------------------------------------------------- load

    def load_events(self, pattern: str, disposition: str = "append", force: bool = False,
                    schema=None, recursive: bool = False) -> ing.IngestResult:
        """Raw events land partitioned by ``EVENT_DATE`` (the event day), so a
        load window prunes raw partitions instead of listing every file."""
        return ing.ingest(self.spark, pattern, self.path("raw", "events"), "events",
                          self.path("raw", "_ledger"), disposition, force, schema, recursive,
                          partition=(RAW_EVENT_DATE, F.to_date("EVENT_TIME")))

    def load_companies(self, pattern: str, disposition: str = "truncate_append",
                       force: bool = False) -> ing.IngestResult:
        from consentflow.sources.schemas import RAW_COMPANY_SCHEMA
        return ing.ingest(self.spark, pattern, self.path("raw", "country_and_industry"),
                          "country_and_industry", self.path("raw", "_ledger"), disposition, force,
                          RAW_COMPANY_SCHEMA)

    def seed_countries(self, csv_path: str) -> None:
        """SRC-05: the country seed, replaced on every seed run."""
        incremental.replace_rows(files.read_country_seed(self.spark, csv_path), self.path("raw", "countries"))

    def raw_events(self) -> DataFrame:
        """Loaded raw events; of a file that was loaded again after a change,
        the newest load alone."""
        return led.current_rows(self.read("raw", "events"), led.read_ledger(self.spark, self.path("raw", "_ledger")), "events")

    # ----------------------------------------------------------------- build

    def build(self, window: LoadWindow | None = None, full_refresh: bool = False,
              run_id: str | None = None, threads: int = 4,
              keep_unmatched: bool = False, expected: list[tuple[dict, str, float]] | None = None) -> dict[str, str]:
        """Build every model.

        First run (no fact yet) or ``full_refresh``: everything is loaded
        (INC-04/05). Otherwise an incremental run over ``window``, by default
        yesterday → today (PRJ-14). The independent dimension rebuilds are
        submitted concurrently from ``threads`` driver threads; Spark runs
        their jobs side by side. The report rows are checked on their way to the
        table (``checks.ObservedChecks``): ``violations`` holds the numbers after it."""
        spark = self.spark
        run_id = run_id or uuid.uuid4().hex
        raw_events = self.raw_events()
        done = {}

        # dimensions: full rebuild, concurrently
        dims = {
            "dim_company": mart.dim_company(staging.stg_company(self.read("raw", "country_and_industry")), run_id),
            "dim_country": mart.dim_country(staging.stg_country(self.read("raw", "countries")), run_id),
            "dim_date": mart.build_dim_date(spark, run_id),
        }
        with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
            futures = {name: pool.submit(incremental.replace_rows, df, self.path("mart", name))
                       for name, df in dims.items()}
            for name, fut in futures.items():
                fut.result()
                done[name] = "rebuilt"

        fct_event_t = PartitionedTable(spark, self.path("mart", "fct_event"), "event_dt")
        fct_consent_t = PartitionedTable(spark, self.path("mart", "fct_consent"), "event_dt")
        report_t = PartitionedTable(spark, self.path("report", "consent_company_day"), "date_day")
        incremental_run = not full_refresh and fct_event_t.exists()
        w = (window or LoadWindow()) if incremental_run else None

        # event fact: the staged batch, key-replaced by event_uq
        if w is not None and RAW_EVENT_DATE in raw_events.columns:
            raw_events = raw_events.where(w.on_date(RAW_EVENT_DATE))  # partition pruning
        batch = mart.fct_event(staging.stg_event(raw_events, w, run_id)) \
            .withColumn("event_dt", F.to_date("event_dttm"))
        if incremental_run:
            fct_event_t.key_replace(batch, ["event_uq"])
        else:
            fct_event_t.overwrite(batch)
        done["fct_event"] = "key-replaced" if incremental_run else "full"

        # consent fact: the window of the (updated) event fact
        fct_event = fct_event_t.read()
        if w is not None:  # partition pruning on event_dt, then the exact timestamp window
            fct_event = fct_event.where(w.on_date("event_dt"))
        consent_batch = mart.fct_consent(staging.stg_consent(fct_event, w, run_id))
        if incremental_run:
            fct_consent_t.key_replace(consent_batch, ["consent_uq"])
        else:
            fct_consent_t.overwrite(consent_batch)
        done["fct_consent"] = done["fct_event"]

        # report: the window of the consent fact with current dimension members
        rep = report.consent_company_day(fct_consent_t.read(), self.read("mart", "dim_company"),
                                         self.read("mart", "dim_date"), w, run_id,
                                         keep_unmatched=keep_unmatched)
        watched = checks.ObservedChecks("consent_uq", "event_count", expected, whole=not incremental_run)
        rep = watched.watch(rep)
        if incremental_run:
            report_t.key_replace(rep, ["consent_uq"])
        else:
            report_t.overwrite(rep)
        self.violations = watched.violations()
        done["consent_company_day"] = done["fct_event"]
        return done

    # ----------------------------------------------------------------- test

    def test(self, expected: list[tuple[dict, str, float]] | None = None,
             raise_on_failure: bool = False) -> dict[str, int]:
        """Run the data checks on the report; each value is the number of
        violating rows (0 = pass). With ``raise_on_failure`` a failing check
        raises (every check has error severity), listing all failures."""
        rep = self.read("report", "consent_company_day")
        out = checks.report_violations(rep, "consent_uq", "event_count")
        for i, (key, col, value) in enumerate(expected or []):
            out[f"expected_{i}"] = checks.check_expected(rep, key, col, value).count()
        failed = {k: v for k, v in out.items() if v}
        if failed and raise_on_failure:
            raise DataCheckError(f"data checks failed: {failed}")
        return out

    def register(self, layers=("raw", "mart", "report"), prefix: str = "") -> list[str]:
        """Expose the layers to SQL as databases (``mart.fct_event``,
        ``report.consent_company_day``…) located in the warehouse root, so
        schema-qualified SQL runs unchanged through ``spark.sql``. Partitioned
        tables get their partitions registered; call again after a build to
        pick up new days."""
        spark = self.spark
        names = []
        for layer in layers:
            db = f"{prefix}{layer}"
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{self.root.rstrip('/')}/{layer}'")
            for name in _list_dirs(spark, f"{self.root.rstrip('/')}/{layer}"):
                if name.startswith("_"):
                    continue
                spark.sql(f"CREATE TABLE IF NOT EXISTS {db}.{name} USING parquet "
                          f"LOCATION '{self.path(layer, name)}'")
                if any("=" in d for d in _list_dirs(spark, self.path(layer, name))):
                    spark.sql(f"ALTER TABLE {db}.{name} RECOVER PARTITIONS")
                spark.catalog.refreshTable(f"{db}.{name}")
                names.append(f"{db}.{name}")
        return names

    def catalog(self, layers=("mart", "report")) -> DataFrame:
        """Column catalogue of the built layers (SRC-27): table, column, position."""
        rows = []
        for layer in layers:
            for name in _list_dirs(self.spark, f"{self.root.rstrip('/')}/{layer}"):
                if name.startswith("_"):
                    continue
                for pos, f in enumerate(self.read(layer, name).schema.fields, 1):
                    rows.append((layer, name, f.name, pos, f.dataType.simpleString()))
        return self.spark.createDataFrame(
            rows, "layer string, table_name string, column_name string, position int, data_type string") \
            .orderBy("table_name", "position")


def _list_dirs(spark: SparkSession, path: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())
