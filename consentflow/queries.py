"""Registered queries: one per operator group of the inventory.

Each entry is ``(spark, sf_dir) -> DataFrame`` over the driver tables of
``sf_dir`` (raw shapes via ``consentflow.sources.driver_tables``). Outputs are
projected for cross-engine comparison: run metadata (run id, ingest and
update stamps, load stamps) is dropped and decimals are exposed as doubles.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from consentflow.functions import random_id, surrogate_key
from consentflow.operators import incremental
from consentflow.operators.sequence import with_neighbour
from consentflow.operators.window_bounds import LoadWindow
from consentflow.plans import analysis, checks, mart, report, staging
from consentflow.plans.graph import ModelGraph
from consentflow.session import scratch_path
from consentflow.sources import driver_tables, roundtrip
from consentflow.warehouse import PartitionedTable

VOLATILE = ("run_id", "ingest_dttm", "update_dttm", "load_time", "load_no")
# 9999-12-31 lies outside some clients' nanosecond timestamps: compared as text
VALIDITY_BOUNDS = ("valid_from", "valid_to")

# Backfill window used by the incremental queries (whole days, inclusive).
BACKFILL = LoadWindow(_dt.date(2024, 1, 10), _dt.date(2024, 1, 12))


def comparable(df: DataFrame) -> DataFrame:
    """Drop volatile metadata, expose decimals as double, dates as midnight
    ``timestamp_ntz`` and validity bounds as ISO text (client libraries render
    dates differently per engine and cannot hold year 9999 in nanosecond
    timestamps; the oracle applies the same presentation)."""
    cols = []
    for f in df.schema.fields:
        if f.name in VOLATILE:
            continue
        if isinstance(f.dataType, T.DecimalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        elif f.name in VALIDITY_BOUNDS:
            cols.append(F.col(f.name).cast("string").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _g(spark, sf_dir, window=None) -> ModelGraph:
    """The lazy model graph over one input directory, built for each call: the
    files are listed anew, so a changed input shows in the next result."""
    return ModelGraph(spark, sf_dir, window)


def _q(build: Callable[[ModelGraph], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build(_g(spark, sf_dir)))
    run.__doc__ = build.__doc__
    return run


def _dim_date_used(g: ModelGraph) -> DataFrame:
    """Calendar members referenced by the event fact (semi join on the date
    key). Event days are de-duplicated before they are hashed."""
    days = g.fct_event.select(F.to_date("event_dttm").alias("d")).distinct()
    return g.dim_date.join(days.select(surrogate_key("d").alias("date_sk")), "date_sk", "left_semi")


def _delete_insert(g: ModelGraph) -> DataFrame:
    batch = staging.stg_consent(g.fct_event, BACKFILL)
    return incremental.delete_insert(g.fct_consent, mart.fct_consent(batch), ["consent_uq"])


def _schema_drift(g: ModelGraph) -> DataFrame:
    """Events before a day were stored without ``parameters``; all others,
    events without a time too, have it."""
    before = F.col("event_dttm") < F.lit(_dt.datetime(2024, 1, 10)).cast("timestamp_ntz")
    old, new = g.fct_event.where(before), g.fct_event.where(~F.coalesce(before, F.lit(False)))
    return incremental.append_new_columns(old.drop("parameters"), new)


def _key_replace_changed(g: ModelGraph) -> DataFrame:
    """A stored fact with a null day, key-replaced by a batch that changes
    values, repeats keys, adds keys and has rows of the null day."""
    day = F.when(F.col("company_id") != "3", F.col("event_dt"))
    target = g.fct_consent.select("consent_uq", "company_id", day.alias("event_dt"), "event_count")
    days = target.where(F.col("event_dt").between(BACKFILL.start, BACKFILL.end))
    batch = (days.withColumn("event_count", F.col("event_count") * 2)
             .unionByName(days.where("company_id = '1'").withColumn("event_count", F.col("event_count") + 1))
             .unionByName(days.withColumn("consent_uq", F.concat("consent_uq", F.lit("-new"))))
             .unionByName(target.where("event_dt IS NULL AND consent_uq < '8'").withColumn("event_count", F.lit(-1.0))))
    base = scratch_path(g.spark, f"roundtrip/replace-{uuid.uuid4().hex[:10]}")
    try:
        table = PartitionedTable(g.spark, f"{base}/fact", "event_dt")
        table.overwrite(target)
        table.key_replace(batch, ["consent_uq"])
        return table.read().checkpoint()
    finally:
        incremental.delete_path(g.spark, base)


def _type_widening(g: ModelGraph) -> DataFrame:
    """A stored fact whose columns come back wider: counts as int, bigint beyond
    its range, then double; ids as int, then decimal; a batch in the first types
    again."""
    f = g.fct_event.select("event_id", F.to_date("event_dttm").alias("event_dt"), F.col("sample_count").cast("int").alias("n"),
                           (F.col("event_id").cast("long") % 1000).cast("int").alias("code")).where("event_dt IS NOT NULL")
    span = lambda lo, hi: f.where(F.col("event_dt").between(_dt.date(2024, 1, lo), _dt.date(2024, 1, hi)))
    base = scratch_path(g.spark, f"roundtrip/widen-{uuid.uuid4().hex[:10]}")
    try:
        table = PartitionedTable(g.spark, f"{base}/fact", "event_dt")
        table.overwrite(span(1, 5))
        table.key_replace(span(4, 10).withColumns({"n": F.col("n").cast("long") * 3_000_000_000}), ["event_id"])
        table.key_replace(span(10, 15).withColumns({"n": F.col("n") + F.lit(0.5), "code": F.col("code").cast("decimal(14,2)") + F.lit(1).cast("decimal(3,2)")}), ["event_id"])
        table.partition_replace(span(16, 31))
        return table.read().checkpoint()
    finally:
        incremental.delete_path(g.spark, base)


def _hot_user(g: ModelGraph) -> DataFrame:
    """Next events where one user holds three of five events."""
    e = g.fct_event.select("event_id", "event_dttm", "event_type",
                           F.when(F.col("event_id").cast("long") % 5 < 3, "hot").otherwise(F.col("user_id")).alias("user_id"))
    return with_neighbour(e, ["user_id"], ["event_dttm", "event_id"], ["event_id", "event_type"], "next")


def _versioned(g: ModelGraph) -> DataFrame:
    """Company members with an ended, a current and a future version; two
    companies have no current one."""
    d = g.dim_company
    ts = lambda y: F.lit(_dt.datetime(y, 1, 1)).cast("timestamp_ntz")
    ended = d.withColumns({"valid_to": ts(2000), "industry_front": F.lit("ended")})
    future = d.withColumns({"valid_from": ts(2200), "industry_front": F.lit("future")})
    return ended.unionByName(d.where(~F.col("company_id").isin("4", "7"))).unionByName(future)


def _changing_companies(g: ModelGraph) -> DataFrame:
    """Company versions that change among the events: a first one until noon of
    the 10th, a next one from then to the 20th (to the 14th for company 3, whose
    history has a gap), a last one from the 21st; company 5 has no first one."""
    d = g.dim_company.select("company_id", "industry_front", "hq_country", "valid_from", "valid_to")
    ts = lambda *a: F.lit(_dt.datetime(2024, 1, *a)).cast("timestamp_ntz")
    named = lambda tag: F.concat("industry_front", F.lit(tag))
    first = d.where("company_id <> '5'").withColumns({"valid_to": ts(10, 12), "industry_front": named(" before")})
    second = d.withColumns({"valid_from": ts(10, 12), "valid_to": F.when(F.col("company_id") == "3", ts(14)).otherwise(ts(20))})
    last = d.withColumns({"valid_from": ts(21), "industry_front": named(" after"), "hq_country": F.lit("moved")})
    return first.unionByName(second).unionByName(last)


def _hot_company(g: ModelGraph) -> DataFrame:
    """Events where company 1 holds three of five."""
    return g.fct_event.withColumn("company_id", F.when(F.col("event_id").cast("long") % 5 < 3, "1").otherwise(F.col("company_id")))


def _reach_sketch(g: ModelGraph, *by: str) -> DataFrame:
    """Reach rolled up from stored company-day states, checked against the events."""
    base = scratch_path(g.spark, f"roundtrip/reach-{uuid.uuid4().hex[:10]}")
    try:
        analysis.reach_states(g.fct_event).write.parquet(base)
        return analysis.reach_within_bound(g.spark.read.parquet(base), g.fct_event, *by).checkpoint()
    finally:
        incremental.delete_path(g.spark, base)


def _report_versions(g: ModelGraph, keep: bool) -> DataFrame:
    return report.consent_company_day(g.fct_consent, _versioned(g), g.dim_date, keep_unmatched=keep)


def _calendar_orders(g: ModelGraph) -> DataFrame:
    """Every day between the first and the last order, and the default member,
    with its calendar attributes and number of orders."""
    orders = driver_tables.table(g.spark, g.sf_dir, "orders").select(F.to_date("o_orderdate").alias("date_day"))
    lo, hi = orders.agg(F.min("date_day"), F.max("date_day")).first()
    cal = mart.dim_date(staging.stg_date(g.spark, lo, hi))
    n = orders.groupBy("date_day").agg(F.count(F.lit(1)).alias("order_count"))
    return cal.join(n, "date_day", "left").withColumn("order_count", F.coalesce("order_count", F.lit(0)))


def _broken_report(g: ModelGraph) -> DataFrame:
    """The report without company 2, with company 9 twice and company 3 doubled."""
    r = g.consent_company_day.where("company_id <> '2'")
    r = r.withColumn("event_count", F.when(F.col("company_id") == "3", F.col("event_count") * 2).otherwise(F.col("event_count")))
    return r.unionByName(r.where("company_id = '9'"))


def _observed(g: ModelGraph) -> DataFrame:
    """Counts taken while a report with negative counts, null keys of company 7
    and one wrong expectation is written."""
    r = _negative(g)
    r = r.withColumn("consent_uq", F.when(F.col("company_id") != "7", F.col("consent_uq")))
    watched = checks.ObservedChecks("consent_uq", "event_count", [({"company_id": "none"}, "event_count", 1.0)])
    watched.watch(r).write.format("noop").mode("overwrite").save()
    return r.sparkSession.createDataFrame(list(watched.violations().items()), "check_name string, violations bigint")


def _expected(g: ModelGraph) -> DataFrame:
    """The report's expected counts: the fact's."""
    return g.fct_consent.select("company_id", F.col("event_dt").alias("date_day"), F.col("event_count").alias("expected"))


def _negative(g: ModelGraph) -> DataFrame:
    r = g.consent_company_day
    return r.withColumn("event_count", F.when(F.col("company_id") == "5", -F.col("event_count")).otherwise(F.col("event_count")))


def _uuids(g: ModelGraph) -> DataFrame:
    """A random id for every event (FN-23): all of one form, none twice."""
    ids = g.raw_events.select(random_id().alias("id"))
    ok = F.rlike("id", F.lit("^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"))
    return ids.agg(F.count(F.lit(1)).alias("event_rows"), F.countDistinct("id").alias("distinct_ids"), F.count(F.when(ok, 1)).alias("well_formed"))


def _pending_days(g: ModelGraph) -> DataFrame:
    """Event days not yet in the consent fact of the backfill window (EXCEPT)."""
    have = staging.stg_consent(g.fct_event, BACKFILL).select(F.col("event_dt")).distinct()
    # distinct first (a partial aggregate): the EXCEPT then compares day sets,
    # never shuffling raw rows keyed by one (possibly hot) day
    days = g.raw_events.select(F.to_date("EVENT_TIME").alias("event_dt")).distinct()
    return days.subtract(have)


def _ingest(g: ModelGraph) -> DataFrame:
    """CSV + Parquet files → ledger-driven ingest → raw table (lineage dropped)."""
    return roundtrip.ingest_roundtrip(g.spark, g.raw_events).drop("filename")


def _stream(g: ModelGraph) -> DataFrame:
    """Parquet files → streaming file source (availableNow) → raw table."""
    return roundtrip.stream_roundtrip(g.spark, g.raw_events).drop("filename")


def _stream_consent(g: ModelGraph) -> DataFrame:
    """Parquet files → streaming rollup by event store → company × day fact."""
    return mart.fct_consent(roundtrip.stream_consent_roundtrip(g.spark, g.raw_events))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # models
    "stg_event": _q(lambda g: g.stg_event),
    "stg_company": _q(lambda g: g.stg_company),
    "stg_country": _q(lambda g: g.stg_country),
    "dim_company": _q(lambda g: g.dim_company),
    "dim_country": _q(lambda g: g.dim_country),
    "dim_date_used": _q(_dim_date_used),
    "fct_event": _q(lambda g: g.fct_event),
    "stg_consent": _q(lambda g: g.stg_consent),
    "fct_consent": _q(lambda g: g.fct_consent),
    "consent_company_day": _q(lambda g: g.consent_company_day),
    "report_keep_unmatched": _q(lambda g: g.report_keep_unmatched()),
    # joins
    "event_by_country": _q(lambda g: analysis.events_by_country(g.fct_event, g.dim_country)),
    "events_with_industry": _q(lambda g: analysis.events_with_industry(g.fct_event, g.dim_company)),
    "known_countries_semi": _q(lambda g: analysis.known_countries(g.fct_event, g.dim_country)),
    "unknown_countries_anti": _q(lambda g: analysis.unknown_countries(g.fct_event, g.dim_country)),
    "orphan_companies_anti": _q(lambda g: analysis.orphan_companies(g.fct_event, g.dim_company)),
    "idle_companies_anti": _q(lambda g: analysis.idle_companies(g.fct_event, g.dim_company)),
    # sequences / windows
    "time_to_consent": _q(lambda g: analysis.time_to_consent_daily(g.fct_event, events=g.consent_events)),
    "time_to_consent_lag": _q(lambda g: analysis.consent_response_times(g.fct_event)),
    "time_to_consent_session": _q(lambda g: analysis.time_to_consent_session(g.fct_event)),
    "first_consent_after": _q(lambda g: analysis.first_consent_after(g.fct_event)),
    "switching_users": _q(lambda g: analysis.switching_users(g.fct_event)),
    "avg_time_to_consent_company": _q(lambda g: analysis.time_to_consent_company(
        g.fct_event, events=g.consent_events)),
    # aggregates
    "company_totals": _q(lambda g: analysis.company_totals(g.fct_event)),
    "company_profile": _q(lambda g: analysis.company_profile(g.fct_event, g.dim_company,
                                                             events=g.consent_events)),
    "consent_status_share": _q(lambda g: analysis.consent_status_share(g.fct_event)),
    "device_share": _q(lambda g: analysis.device_share(g.fct_event)),
    "geo_reach": _q(lambda g: analysis.geo_reach(g.fct_event)),
    "hourly_given": _q(lambda g: analysis.hourly_given(g.fct_event)),
    "hourly_asked_given": _q(lambda g: analysis.hourly_asked_given(g.fct_event)),
    "industry_rate_of_sums": _q(lambda g: analysis.industry_rate_of_sums(g.consent_company_day)),
    "industry_avg_rate": _q(lambda g: analysis.industry_avg_rate(g.consent_company_day)),
    "hq_totals": _q(lambda g: analysis.hq_totals(g.consent_company_day)),
    "raw_volume": _q(lambda g: analysis.raw_volume(g.raw_events)),
    "duplicate_event_ids": _q(lambda g: analysis.key_counts(g.raw_events, ["EVENT_ID"], 2)),
    "events_per_company": _q(lambda g: analysis.events_per_company(g.fct_event)),
    "type_rate_consent_profile": _q(lambda g: analysis.type_rate_consent_profile(g.raw_events)),
    "null_key_probes": _q(lambda g: analysis.null_key_probes(g.raw_events, g.raw_companies)),
    "user_type_counts": _q(lambda g: analysis.user_type_counts(g.fct_event)),
    "anomalous_consent": _q(lambda g: analysis.anomalous_consent(g.fct_event)),
    "hq_gap_count": _q(lambda g: analysis.hq_gap_count(g.dim_company)),
    "distinct_event_types": _q(lambda g: analysis.distinct_event_types(g.fct_event)),
    "table_counts": _q(lambda g: analysis.table_counts(g.raw_events, g.fct_event, g.fct_consent,
                                                       g.consent_company_day)),
    # sort / limit
    "top_companies": _q(lambda g: analysis.top_companies(g.fct_event)),
    "report_preview": _q(lambda g: analysis.report_preview(g.consent_company_day)),
    # incremental
    "incremental_filter": _q(lambda g: staging.stg_event(g.raw_events, BACKFILL)),
    "backfill_window": _q(lambda g: staging.stg_consent(g.fct_event, BACKFILL)),
    "delete_insert": _q(_delete_insert),
    "schema_drift_append": _q(_schema_drift),
    "pending_days_except": _q(_pending_days),
    "duplicate_consent_keys": _q(lambda g: incremental.duplicate_keys(g.fct_consent, ["consent_uq"])),
    # ingestion
    "ingest_roundtrip": _q(_ingest),
    "stream_ingest": _q(_stream),
    "stream_consent_daily": _q(_stream_consent),
    # checks
    "check_unique": _q(lambda g: checks.check_unique(g.consent_company_day, "consent_uq")),
    "check_not_null": _q(lambda g: checks.check_not_null(g.stg_company, "hq_country").select("company_id", "industry_front")),
    "check_positive": _q(lambda g: checks.check_positive(g.consent_company_day, "event_count")),
    "check_not_empty": _q(lambda g: checks.check_not_empty(g.consent_company_day)),
    "check_expected": _q(lambda g: checks.check_expected_values(
        g.consent_company_day, _expected(g), ["company_id", "date_day"], "event_count")),
    "reconcile_raw_report": _q(lambda g: checks.reconcile_raw_report(g.raw_events,
                                                                     g.consent_company_day)),
    # checks on rows that break them
    "violations_unique": _q(lambda g: checks.check_unique(_broken_report(g), "consent_uq")),
    "violations_positive": _q(lambda g: checks.check_positive(_negative(g), "event_count")),
    "violations_not_empty": _q(lambda g: checks.check_not_empty(g.consent_company_day.where("company_id = 'none'"))),
    "violations_observed": _q(_observed),
    "violations_expected": _q(lambda g: checks.check_expected_values(
        _broken_report(g), _expected(g), ["company_id", "date_day"], "event_count")),
    "violations_reconcile": _q(lambda g: checks.reconcile_raw_report(
        g.raw_events, _broken_report(g).where("company_id <> '9'"))),
    "unknown_countries_found": _q(lambda g: analysis.unknown_countries(g.fct_event, g.dim_country.where("region <> 'ASIA'"))),
    "orphan_companies_found": _q(lambda g: analysis.orphan_companies(
        g.fct_event, g.dim_company.where(~F.col("company_id").isin("2", "5")))),
    "duplicate_event_ids_found": _q(lambda g: analysis.key_counts(
        g.raw_events.unionByName(g.raw_events.where("EVENT_ID LIKE '%7'")), ["EVENT_ID"], 2)),
    "duplicate_consent_keys_found": _q(lambda g: incremental.duplicate_keys(
        g.fct_consent.unionByName(g.fct_consent.where("company_id IN ('1', '8')")), ["consent_uq"])),
    # versions, calendar, order, raw filters, lists, ids
    "report_versions": _q(lambda g: _report_versions(g, False)),
    "report_versions_unmatched": _q(lambda g: _report_versions(g, True)),
    "calendar_orders": _q(_calendar_orders),
    "time_to_next_hot_user": _q(_hot_user),
    "type_widening": _q(_type_widening),
    "events_with_industry_hot": _q(lambda g: analysis.events_with_industry(_hot_company(g), g.dim_company)),
    "report_as_of": _q(lambda g: report.consent_as_of(g.fct_consent, _changing_companies(g))),
    "events_as_of_hot": _q(lambda g: analysis.events_as_of(_hot_company(g), _changing_companies(g))),
    "geo_reach_sketch": _q(lambda g: _reach_sketch(g, "company_id")),
    "geo_reach_sketch_daily": _q(lambda g: _reach_sketch(g, "event_dt", "company_id")),
    "key_replace_changed": _q(_key_replace_changed),
    "hourly_given_ranked": _q(lambda g: analysis.ranked(analysis.hourly_given(g.fct_event), "hour_ts")),
    "events_per_company_ranked": _q(lambda g: analysis.ranked(
        analysis.events_per_company(g.fct_event), F.desc("cnt"), "company_id")),
    "industry_rate_ranked": _q(lambda g: analysis.ranked(
        analysis.industry_rate_of_sums(g.consent_company_day), F.col("conversion_rate").asc_nulls_last(), "industry_front")),
    "raw_volume_total": _q(lambda g: analysis.raw_volume_total(g.raw_events)),
    "raw_volume_quoted": _q(lambda g: analysis.raw_volume_at(g.raw_events, "0", BACKFILL.start, "FRANCE")),
    "company_statuses": _q(lambda g: analysis.company_statuses(g.fct_event)),
    "event_uuids": _q(_uuids),
}
