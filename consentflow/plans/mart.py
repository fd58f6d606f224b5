"""Mart models: dimensions (full rebuild) and facts (key-replace increments)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from consentflow.functions import (
    DATE_MIN, default_int, default_string, null_timestamp, surrogate_key, ts_max, ts_min)
from consentflow.plans import staging


def _meta(run_id: str | None, origin):
    return [F.lit(run_id or "local").alias("run_id"),
            F.current_timestamp().alias("ingest_dttm"),
            null_timestamp().alias("update_dttm"),
            (F.col(origin) if isinstance(origin, str) else origin).alias("origin")]


def dim_company(stg: DataFrame, run_id: str | None = None) -> DataFrame:
    return stg.select(
        surrogate_key("company_id").alias("company_sk"),
        ts_min().alias("valid_from"), ts_max().alias("valid_to"),
        F.coalesce("company_id", default_string()).alias("company_id"),
        F.coalesce("industry_back", default_string()).alias("industry_back"),
        F.coalesce("industry_front", default_string()).alias("industry_front"),
        F.coalesce("hq_country", default_string()).alias("hq_country"),
        *_meta(run_id, "origin"))


def dim_country(stg: DataFrame, run_id: str | None = None) -> DataFrame:
    return stg.select(
        surrogate_key("code").alias("country_sk"),
        ts_min().alias("valid_from"), ts_max().alias("valid_to"),
        F.coalesce("code", default_string()).alias("country_code"),
        F.coalesce("code_numeric", default_int().cast("int")).alias("country_code_numeric"),
        F.coalesce("name", default_string()).alias("country_name"),
        F.coalesce("region", default_string()).alias("region"),
        F.coalesce("subregion", default_string()).alias("subregion"),
        *_meta(run_id, "origin"))


DIM_DATE_ATTRS = ["year", "quarter", "month", "week_no", "day_of_week", "day_of_year",
                  "day_name", "month_name", "week_start", "week_end", "month_start",
                  "month_end", "is_workday", "is_weekend"]


def dim_date(stg: DataFrame, run_id: str | None = None) -> DataFrame:
    """Calendar rows plus the default member keyed on '1900-01-01' (trap D4:
    the key hashes the date text, not the integer 1900-01-01 = 1898)."""
    spark = stg.sparkSession
    rows = stg.select(
        surrogate_key("date_day").alias("date_sk"),
        ts_min().alias("valid_from"), ts_max().alias("valid_to"),
        "date_day", *DIM_DATE_ATTRS, *_meta(run_id, default_string()))
    dmin = F.lit(DATE_MIN)
    zero = default_int().cast("int")
    default = spark.range(1).select(
        surrogate_key(F.lit(DATE_MIN.isoformat())).alias("date_sk"),
        ts_min().alias("valid_from"), ts_max().alias("valid_to"),
        dmin.alias("date_day"),
        zero.alias("year"), zero.alias("quarter"), zero.alias("month"), zero.alias("week_no"),
        zero.alias("day_of_week"), zero.alias("day_of_year"),
        default_string().alias("day_name"), default_string().alias("month_name"),
        dmin.alias("week_start"), dmin.alias("week_end"), dmin.alias("month_start"),
        dmin.alias("month_end"), F.lit(False).alias("is_workday"), F.lit(False).alias("is_weekend"),
        *_meta(run_id, default_string()))
    return rows.unionByName(default)


def build_dim_date(spark: SparkSession, run_id: str | None = None, **kw) -> DataFrame:
    return dim_date(staging.stg_date(spark, **kw), run_id)


FCT_EVENT_COLUMNS = [
    "event_uq", "company_fk", "country_fk", "date_fk", "event_id", "user_id", "company_id",
    "deployment_id", "event_dttm", "event_type", "consent_status", "rate", "parameters",
    "sdk_type", "domain_name", "country_code", "region_code", "browser_family", "device_type",
    "sample_count", "event_count", "run_id", "ingest_dttm", "update_dttm", "origin",
]

FCT_CONSENT_COLUMNS = [
    "consent_uq", "date_fk", "company_fk", "company_id", "event_dt",
    *staging.METRIC_COLUMNS, "run_id", "ingest_dttm", "update_dttm", "origin",
]


def fct_event(stg: DataFrame) -> DataFrame:
    """One row per event: the staging batch in fact column order."""
    return stg.select(*FCT_EVENT_COLUMNS)


def fct_consent(stg: DataFrame) -> DataFrame:
    """One row per company and day."""
    return stg.select(*FCT_CONSENT_COLUMNS)
