"""Staging models: rename, clean, key and extrapolate the raw tables."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from consentflow.functions import (
    CONSENT_ASKED, CONSENT_GIVEN, CONSENT_STATUSES, DATE_SPINE_END, DATE_SPINE_START,
    ORIGIN_CONSENT, ORIGIN_SEED, PAGEVIEW, UI_ACTION, conversion_rate, default_int,
    default_string, extrapolated_count, null_timestamp, seconds_between, strip_quotes,
    surrogate_key, ts_min)
from consentflow.operators import window_bounds
from consentflow.operators.sequence import with_neighbour


def _run_id(run_id: str | None):
    return F.lit(run_id or "local").alias("run_id")


# --------------------------------------------------------------------------- events

def stg_event(raw: DataFrame, window: window_bounds.LoadWindow | None = None,
              run_id: str | None = None) -> DataFrame:
    """Raw events → keyed, renamed, extrapolated staging rows (one per event).

    Keys are hashes of business keys (late binding, no dimension lookup while
    loading). ``country_fk`` hashes the unquoted code so it can meet
    ``dim_country`` (trap D3).
    """
    src = window_bounds.apply(raw, window, "EVENT_TIME", "timestamp")
    event_dt = F.to_date("EVENT_TIME")
    country = strip_quotes("COUNTRY")
    return src.select(
        surrogate_key(F.col("EVENT_ID"), event_dt).alias("event_uq"),
        surrogate_key("APIKEY").alias("company_fk"),
        surrogate_key(country).alias("country_fk"),
        surrogate_key(event_dt).alias("date_fk"),
        F.col("EVENT_ID").alias("event_id"),
        F.col("USER_ID").alias("user_id"),
        F.col("APIKEY").alias("company_id"),
        F.col("DEPLOYMENT_ID").alias("deployment_id"),
        F.col("EVENT_TIME").alias("event_dttm"),
        F.col("TYPE").alias("event_type"),
        F.col("CONSENT").alias("consent_status"),
        F.col("RATE").alias("rate"),
        F.col("PARAMETERS").alias("parameters"),
        F.col("SDK_TYPE").alias("sdk_type"),
        F.col("DOMAIN").alias("domain_name"),
        country.alias("country_code"),
        strip_quotes("REGION").alias("region_code"),
        F.col("BROWSER_FAMILY").alias("browser_family"),
        F.col("DEVICE_TYPE").alias("device_type"),
        F.col("COUNT").alias("sample_count"),
        extrapolated_count("COUNT", "RATE").alias("event_count"),
        _run_id(run_id),
        F.current_timestamp().alias("ingest_dttm"),
        null_timestamp().alias("update_dttm"),
        F.col("filename").alias("origin"),
    )


# --------------------------------------------------------------------------- consent

def consent_events(fct_event: DataFrame, window: window_bounds.LoadWindow | None = None,
                   session_keys: tuple[str, ...] = ("user_id",)) -> DataFrame:
    """Event rows of the window with the next event of the same user and the
    asked→given gap in whole seconds (``lag_consent_asked_given_second``).

    The window filter runs before the sequence (the next event is looked up
    inside the load window only, as in the modelled warehouse, trap D6).
    """
    src = window_bounds.apply(fct_event, window, "event_dttm", "timestamp")
    # the sequence writes its input once: only the columns that consumers use
    used = {*session_keys, "event_id", "event_dttm", "event_type", "company_id", "event_count", "consent_status", "country_code"}
    src = src.select(*[c for c in src.columns if c in used])
    seq = with_neighbour(src, list(session_keys), ["event_dttm", "event_id"],
                         ["event_type", "event_dttm"], "next")
    gap = F.when((F.col("event_type") == CONSENT_ASKED) & (F.col("event_type_next") == CONSENT_GIVEN),
                 seconds_between("event_dttm", "event_dttm_next"))
    return seq.select(gap.alias("lag_consent_asked_given_second"),
                      F.to_date("event_dttm").alias("event_dt"), "*")


def _type_sum(t: str):
    return F.sum(F.when(F.col("event_type") == t, F.col("event_count")))


def _given_sum(status: str):
    return F.sum(F.when((F.col("event_type") == CONSENT_GIVEN) & (F.col("consent_status") == status),
                        F.col("event_count")))


def consent_measures() -> list:
    """Aggregate columns shared by the daily fact and company-level rollups.

    Conditional sums stay null when a type/status is absent (no coalesce)."""
    slug = {s: s.replace(" ", "_").replace("-", "_") for s in CONSENT_STATUSES}
    return [
        F.sum("event_count").alias("event_count"),
        _type_sum(PAGEVIEW).alias("event_pageview_count"),
        _type_sum(CONSENT_ASKED).alias("event_consent_asked_count"),
        _type_sum(CONSENT_GIVEN).alias("event_consent_given_count"),
        _type_sum(UI_ACTION).alias("event_ui_action_count"),
    ] + [_given_sum(s).alias(f"consent_given_{slug[s]}_count") for s in CONSENT_STATUSES]


METRIC_COLUMNS = [
    "event_count", "event_pageview_count", "event_consent_asked_count",
    "event_consent_given_count", "event_ui_action_count", "consent_given_full_opt_in_count",
    "consent_given_opt_out_count", "consent_given_partial_opt_in_count",
    "consent_given_empty_count", "consent_conversion_rate",
]


def consent_totals(fct_event: DataFrame, window=None, with_lag: bool = False) -> DataFrame:
    """Company × day totals (AGG-01..05). The asked→given average needs the
    per-user sequence; when it is not requested the plan has no Window and no
    shuffle by user at all."""
    if with_lag:
        src = consent_events(fct_event, window)
        extra = [F.avg(F.when(F.col("event_type") == CONSENT_ASKED,
                              F.col("lag_consent_asked_given_second")))
                 .alias("lag_consent_asked_given_second_avg")]
    else:
        src = window_bounds.apply(fct_event, window, "event_dttm", "timestamp") \
            .withColumn("event_dt", F.to_date("event_dttm"))
        extra = []
    totals = src.groupBy("company_id", "event_dt").agg(*consent_measures(), *extra)
    return totals.withColumn(
        "consent_conversion_rate",
        conversion_rate("event_consent_given_count", "event_consent_asked_count"))


SUM_COLUMNS = [c for c in METRIC_COLUMNS if c != "consent_conversion_rate"]


def merge_consent(totals: DataFrame) -> DataFrame:
    """Company × day totals of the sums of parts of the events (``SUM_COLUMNS``
    of ``consent_totals``): every measure but the rate adds up."""
    sums = [F.sum(c).cast(totals.schema[c].dataType).alias(c) for c in SUM_COLUMNS]
    return totals.groupBy("company_id", "event_dt").agg(*sums).withColumn(
        "consent_conversion_rate", conversion_rate("event_consent_given_count", "event_consent_asked_count"))


def stg_consent(fct_event: DataFrame, window=None, run_id: str | None = None,
                with_lag: bool = False) -> DataFrame:
    """Company-by-day consent metrics, keyed (one row per company and day)."""
    return key_consent(consent_totals(fct_event, window, with_lag), run_id, with_lag)


def key_consent(m: DataFrame, run_id: str | None = None, with_lag: bool = False) -> DataFrame:
    """Keys and metadata on company × day totals that carry
    ``consent_conversion_rate`` (shared by the batch and streaming paths)."""
    lag = ["lag_consent_asked_given_second_avg"] if with_lag else []
    return m.select(
        surrogate_key("company_id", "event_dt").alias("consent_uq"),
        surrogate_key("company_id").alias("company_fk"),
        surrogate_key("event_dt").alias("date_fk"),
        "company_id", "event_dt", *METRIC_COLUMNS, *lag,
        _run_id(run_id),
        F.current_timestamp().alias("ingest_dttm"),
        null_timestamp().alias("update_dttm"),
        F.lit(ORIGIN_CONSENT).alias("origin"),
    )


# --------------------------------------------------------------------------- reference data

def stg_company(raw: DataFrame) -> DataFrame:
    """Trimmed company attributes plus the default ('n/a') member."""
    spark = raw.sparkSession
    rows = raw.select(
        F.trim("PUBLIC_API_KEY").alias("company_id"),
        F.trim("INDUSTRY_BACK").alias("industry_back"),
        F.trim("INDUSTRY_FRONT").alias("industry_front"),
        F.trim("HQ_COUNTRY").alias("hq_country"),
        F.current_timestamp().cast("timestamp_ntz").alias("ingest_dttm"),
        null_timestamp().alias("update_dttm"),
        F.col("filename").alias("origin"),
    )
    default = spark.range(1).select(
        default_string().alias("company_id"), default_string().alias("industry_back"),
        default_string().alias("industry_front"), default_string().alias("hq_country"),
        ts_min().alias("ingest_dttm"), ts_min().alias("update_dttm"),
        default_string().alias("origin"))
    return rows.unionByName(default)


def stg_country(seed: DataFrame) -> DataFrame:
    spark = seed.sparkSession
    rows = seed.select(
        "name", F.col("alpha_2").alias("code"), F.col("country_code").cast("int").alias("code_numeric"),
        "region", F.col("sub_region").alias("subregion"),
        F.current_timestamp().cast("timestamp_ntz").alias("ingest_dttm"),
        null_timestamp().alias("update_dttm"), F.lit(ORIGIN_SEED).alias("origin"))
    default = spark.range(1).select(
        default_string().alias("name"), default_string().alias("code"),
        default_int().cast("int").alias("code_numeric"), default_string().alias("region"),
        default_string().alias("subregion"), ts_min().alias("ingest_dttm"),
        ts_min().alias("update_dttm"), default_string().alias("origin"))
    return rows.unionByName(default)


def stg_date(spark: SparkSession, start: _dt.date = DATE_SPINE_START,
             end: _dt.date = DATE_SPINE_END, pad_names: bool = False) -> DataFrame:
    """Calendar attributes for every day in [start, end].

    Generated with ``spark.range`` (distributed) rather than one exploded
    array. Day of week is 0=Sunday..6=Saturday, weeks are ISO weeks starting
    Monday. Names are unpadded unless ``pad_names`` (blank-padded to 9, as a
    fixed-width 'Day'/'Month' format renders them, trap D12).
    """
    n_days = (end - start).days + 1
    d = F.date_add(F.lit(start), F.col("id").cast("int"))
    days = spark.range(0, n_days, 1, max(1, min(16, n_days // 4096 + 1))).select(d.alias("date_day"))
    dow = F.dayofweek("date_day") - 1
    day_name = F.date_format("date_day", "EEEE")
    month_name = F.date_format("date_day", "MMMM")
    if pad_names:
        day_name, month_name = F.rpad(day_name, 9, " "), F.rpad(month_name, 9, " ")
    week_start = F.trunc("date_day", "week")
    month_start = F.trunc("date_day", "month")
    weekend = dow.isin(6, 0)
    return days.select(
        "date_day",
        F.year("date_day").alias("year"),
        F.month("date_day").alias("month"),
        F.quarter("date_day").alias("quarter"),
        F.weekofyear("date_day").alias("week_no"),
        dow.alias("day_of_week"),
        F.dayofyear("date_day").alias("day_of_year"),
        day_name.alias("day_name"),
        month_name.alias("month_name"),
        week_start.alias("week_start"),
        F.date_add(week_start, 6).alias("week_end"),
        month_start.alias("month_start"),
        F.last_day("date_day").alias("month_end"),
        (~weekend).alias("is_workday"),
        weekend.alias("is_weekend"),
    )
