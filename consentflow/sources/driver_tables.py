"""Raw event / company / country shapes derived from the driver tables.

The test tables are a generic star schema (events, customer, nation,
region). This adapter derives, row for row, the raw tables the consent mart
consumes, so every model reads data whose volume grows with ``events``:

* events → raw events: view→pageview, click→consent.asked,
  purchase→consent.given, others→ui.action; sampling rate 1.0 for given
  (unsampled), 0.4 for ui.action (gives .5 extrapolation ties), else 0.1;
  ``COUNT = 1 + k % 7`` with ``k`` from ``props``; company = ``user_id % 10``
  (ten active companies among all customers); country/region quoted names of
  nation ``k % 25``; device/browser/deployment/sdk/domain from ``k``.
* customer → companies: market segment as industry, nation as HQ country,
  HQ missing for every sixth customer.
* nation ⨝ region → country seed.

The mapping is mirrored in SQL by ``consentflow.oracle`` for the DuckDB check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from consentflow.functions.metrics import hour_start

# Adapter vocabularies (indexed by k modulo their length).
CONSENT_BY_K = ["full opt-in", "opt-out", "partial opt-in", "empty"]
DEVICE_BY_K = ["smartphone", "desktop", "tablet"]
BROWSER_BY_K = ["Chrome", "Safari", "Firefox", "Mobile SDK"]
SDK_BY_K = ["sdk-web", "sdk-mobile"]
N_COMPANIES_ACTIVE = 10
N_NATIONS = 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(_path(sf_dir, name))


def _path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def file_name():
    """Lineage file name of each row, from the scan's metadata."""
    return F.col("_metadata.file_name")


def _pick(values, idx):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx % len(values)) + 1)


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation ⨝ region; the join strategy is left to the tables' sizes."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        "n_nationkey", "n_name", "n_regionkey", "r_name")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    base = ev.select("event_id", "ts", "user_id", "event_type", "props", file_name().alias("_file"))
    base = base.withColumn("_k", F.get_json_object("props", "$.k").cast("int"))
    nat = nations(spark, sf_dir)
    j = base.join(nat, (base._k % N_NATIONS) == nat.n_nationkey, "left")
    typ = (F.when(F.col("event_type") == "view", "pageview")
           .when(F.col("event_type") == "click", "consent.asked")
           .when(F.col("event_type") == "purchase", "consent.given")
           .otherwise("ui.action"))
    rate = (F.when(typ == "consent.given", 1.0).when(typ == "ui.action", 0.4)
            .otherwise(0.1))
    kk = F.col("_k")
    return j.select(
        F.col("event_id").cast("string").alias("EVENT_ID"),
        F.col("user_id").cast("string").alias("USER_ID"),
        typ.alias("TYPE"),
        rate.cast("double").alias("RATE"),
        F.col("props").alias("PARAMETERS"),
        F.col("ts").alias("EVENT_TIME"),
        hour_start("ts").alias("WINDOW_START"),
        (F.col("user_id") % N_COMPANIES_ACTIVE).cast("string").alias("APIKEY"),
        _pick(CONSENT_BY_K, kk).alias("CONSENT"),
        (F.lit(1) + kk % 7).cast("long").alias("COUNT"),
        F.lit(None).cast("double").alias("EXPERIMENT"),
        _pick(SDK_BY_K, kk).alias("SDK_TYPE"),
        F.concat(F.lit("service"), (kk % 6).cast("string"), F.lit(".org")).alias("DOMAIN"),
        F.concat(F.lit("dep-"), (kk % 5).cast("string")).alias("DEPLOYMENT_ID"),
        F.concat(F.lit('"'), F.col("n_name"), F.lit('"')).alias("COUNTRY"),
        F.concat(F.lit('"'), F.col("r_name"), F.lit('"')).alias("REGION"),
        _pick(BROWSER_BY_K, kk).alias("BROWSER_FAMILY"),
        _pick(DEVICE_BY_K, kk).alias("DEVICE_TYPE"),
        F.current_timestamp().alias("load_time"),
        F.lit("driver").alias("load_no"),
        F.col("_file").alias("filename"),
    )


def raw_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment", file_name().alias("_file"))
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = c.join(n, c.c_nationkey == n.n_nationkey, "left")
    return j.select(
        F.col("c_custkey").cast("string").alias("PUBLIC_API_KEY"),
        F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(" ")).alias("INDUSTRY_BACK"),
        F.initcap(F.col("c_mktsegment")).alias("INDUSTRY_FRONT"),
        F.when(F.col("c_custkey") % 6 == 0, F.lit(None)).otherwise(F.col("n_name")).alias("HQ_COUNTRY"),
        F.current_timestamp().alias("load_time"),
        F.lit("driver").alias("load_no"),
        F.col("_file").alias("filename"),
    )


def country_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    nat = nations(spark, sf_dir)
    return nat.select(
        F.col("n_name").alias("name"),
        F.col("n_name").alias("alpha_2"),
        F.col("n_name").alias("alpha_3"),
        F.col("n_nationkey").cast("int").alias("country_code"),
        F.concat(F.lit("ISO 3166-2:"), F.col("n_name")).alias("iso_3166_2"),
        F.col("r_name").alias("region"),
        F.col("r_name").alias("sub_region"),
        F.lit(None).cast("string").alias("intermediate_region"),
        F.col("n_regionkey").cast("int").alias("region_code"),
        F.col("n_regionkey").cast("int").alias("sub_region_code"),
        F.lit(None).cast("int").alias("intermediate_region_code"),
    )
