"""Analysis queries over the mart: profiles, rollups, sequences, rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from consentflow.functions import (
    CONSENT_ASKED, CONSENT_GIVEN, conversion_rate, hour_start, micros_between, seconds_between)
from consentflow.operators.as_of import as_of
from consentflow.operators.salted_join import salted_join
from consentflow.operators.sequence import first_following_where, with_neighbour
from consentflow.operators.shares import share_by
from consentflow.plans import staging

SEQ_ORDER = ["event_dttm", "event_id"]
REACH_LG_K = 12
REACH_ERROR = 1.04 / 2 ** (REACH_LG_K / 2)  # relative standard error of a sketch


# --------------------------------------------------------------------------- time to consent

def time_to_consent_daily(fct_event: DataFrame, window=None, events: DataFrame | None = None) -> DataFrame:
    """Average asked→given seconds per company and day (AGG-05, WIN-01..03).
    ``events`` may pass an already built ``staging.consent_events`` frame."""
    ev = events if events is not None else staging.consent_events(fct_event, window)
    return ev.groupBy("company_id", "event_dt").agg(
        F.avg(F.when(F.col("event_type") == CONSENT_ASKED, F.col("lag_consent_asked_given_second")))
        .alias("lag_consent_asked_given_second_avg"),
        F.count(F.col("lag_consent_asked_given_second")).alias("matched_asked_count"))


def time_to_consent_company(fct_event: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """Overall asked→given average per company (AGG-24)."""
    ev = events if events is not None else staging.consent_events(fct_event)
    return ev.groupBy("company_id").agg(
        F.avg(F.when(F.col("event_type") == CONSENT_ASKED, F.col("lag_consent_asked_given_second")))
        .alias("avg_time_to_consent_second"))


def consent_response_times(fct_event: DataFrame) -> DataFrame:
    """Backward form (WIN-04): a given preceded by an asked of the same user →
    elapsed seconds (exact, with fraction)."""
    src = fct_event.select("user_id", "company_id", "deployment_id", "event_id", "event_dttm", "event_type")
    seq = with_neighbour(src, ["user_id"], SEQ_ORDER, ["event_type", "event_dttm"], "prev")
    resp = F.when((F.col("event_type") == CONSENT_GIVEN) & (F.col("event_type_prev") == CONSENT_ASKED),
                  micros_between("event_dttm_prev", "event_dttm") / 1e6)
    return (seq.select("user_id", "company_id", "deployment_id", "event_id", "event_dttm",
                       "event_type", resp.alias("consent_response_seconds"))
            .where(F.col("consent_response_seconds").isNotNull()))


SESSION_KEYS = ("user_id", "country_code", "deployment_id", "region_code", "browser_family")


def time_to_consent_session(fct_event: DataFrame) -> DataFrame:
    """Pseudo-session matching (WIN-05): the next event within the same user,
    country, deployment, region and browser."""
    ev = staging.consent_events(fct_event, session_keys=SESSION_KEYS)
    return (ev.where(F.col("lag_consent_asked_given_second").isNotNull())
            .select("event_id", "user_id", "company_id", "event_dttm",
                    "lag_consent_asked_given_second"))


def first_consent_after(fct_event: DataFrame) -> DataFrame:
    """Minutes from each consent.asked to the user's first consent.given at or
    after it (WIN-06, fixed form: nulls are skipped). Skew-safe: hot users are
    split into time buckets (``first_following_where``)."""
    x = first_following_where(
        fct_event.select("event_id", "user_id", "company_id", "event_dttm", "event_type"),
        ["user_id"], SEQ_ORDER, "event_dttm", F.col("event_type") == CONSENT_GIVEN,
        "first_given_dttm")
    minutes = micros_between("event_dttm", "first_given_dttm") / 6e7
    return (x.where(F.col("event_type") == CONSENT_ASKED)
            .select("event_id", "user_id", "company_id", "event_dttm", "first_given_dttm",
                    minutes.alias("minutes_to_first_given")))


def switching_users(fct_event: DataFrame, max_gap_minutes: int = 60) -> DataFrame:
    """Same user seen in another country or region or on another device within
    a short gap of the previous event (WIN-07)."""
    places = ["country_code", "region_code", "device_type"]
    seq = with_neighbour(fct_event.select("user_id", "event_id", "event_dttm", *places),
                         ["user_id"], SEQ_ORDER, [*places, "event_dttm"], "prev")
    gap = seconds_between("event_dttm_prev", "event_dttm")
    changed = F.lit(False)
    for c in places:
        changed = changed | (F.col(c) != F.col(f"{c}_prev"))
    return (seq.where(changed & (gap <= max_gap_minutes * 60))
            .select("user_id", "event_id", "event_dttm",
                    *[x for c in places for x in (F.col(f"{c}_prev").alias(f"prev_{c}"), F.col(c))],
                    gap.alias("gap_second")))


# --------------------------------------------------------------------------- company rollups

def company_totals(fct_event: DataFrame) -> DataFrame:
    """All-time company totals with the daily fact's measures (AGG-06)."""
    t = fct_event.groupBy("company_id").agg(*staging.consent_measures())
    return t.withColumn("consent_conversion_rate",
                        conversion_rate("event_consent_given_count", "event_consent_asked_count"))


def geo_reach(fct_event: DataFrame) -> DataFrame:
    """Distinct event countries per company (AGG-22)."""
    return fct_event.groupBy("company_id").agg(
        F.countDistinct("country_code").alias("distinct_countries"))


def reach_states(fct_event: DataFrame) -> DataFrame:
    """Mergeable reach of each company and day (AGG-22, approximate form):
    sketches of its countries and users, a few kilobytes each whatever the number
    of events. Kept as a table, they answer any span of days without the events."""
    return fct_event.groupBy("company_id", F.to_date("event_dttm").alias("event_dt")).agg(
        F.hll_sketch_agg("country_code", F.lit(REACH_LG_K)).alias("countries"),
        F.hll_sketch_agg("user_id", F.lit(REACH_LG_K)).alias("users"))


def reach_of(states: DataFrame, *by: str) -> DataFrame:
    """Roll stored reach states up to ``by``: estimated distinct countries and
    users. Counts are within 3 * ``REACH_ERROR`` of the exact ones (99.7 %)."""
    return states.groupBy(*by).agg(
        F.hll_sketch_estimate(F.hll_union_agg("countries")).alias("distinct_countries"),
        F.hll_sketch_estimate(F.hll_union_agg("users")).alias("distinct_users"))


def reach_within_bound(states: DataFrame, fct_event: DataFrame, *by: str) -> DataFrame:
    """Exact reach beside whether the rolled-up sketches agree with it within
    their bound (the estimate itself is no exact figure)."""
    exact = fct_event.withColumn("event_dt", F.to_date("event_dttm")).groupBy(*by).agg(
        F.countDistinct("country_code").alias("distinct_countries"), F.countDistinct("user_id").alias("distinct_users"))
    names = ("distinct_countries", "distinct_users")
    guess = reach_of(states, *by).select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(by)], *[F.col(c).alias(f"about_{c}") for c in names])
    on = [exact[c].eqNullSafe(guess[f"k{i}"]) for i, c in enumerate(by)]
    j = exact.join(guess, on, "left")
    near = [F.abs(F.col(f"about_{c}") - F.col(c)) <= F.greatest(F.lit(1.0), 3 * REACH_ERROR * F.col(c)) for c in names]
    return j.select(*by, *names, F.coalesce(near[0] & near[1], F.lit(False)).alias("within_bound"))


def company_profile(fct_event: DataFrame, dim_company: DataFrame,
                    events: DataFrame | None = None) -> DataFrame:
    """Volume, type breakdown, reach and time to consent per company, enriched
    with industry and HQ (AGG-23). All inputs are aggregated to one row per
    company before joining, so the joins are on small, unique keys."""
    # all measures in one aggregate over the events with their gaps
    ev = events if events is not None else staging.consent_events(fct_event)
    tot = ev.groupBy("company_id").agg(
        *staging.consent_measures(), F.countDistinct("country_code").alias("distinct_countries"),
        F.avg(F.when(F.col("event_type") == CONSENT_ASKED, F.col("lag_consent_asked_given_second")))
        .alias("avg_time_to_consent_second"))
    tot = tot.withColumn("consent_conversion_rate",
                         conversion_rate("event_consent_given_count", "event_consent_asked_count"))
    comp = dim_company.select("company_id", "industry_back", "industry_front", "hq_country")
    return tot.join(comp, "company_id", "left")


def consent_status_share(fct_event: DataFrame) -> DataFrame:
    """Given consents per status and their share of the company's given (AGG-20)."""
    given = fct_event.where(F.col("event_type") == CONSENT_GIVEN)
    return share_by(given, ["company_id"], ["consent_status"], "event_count",
                    "given_count", "given_share")


def device_share(fct_event: DataFrame) -> DataFrame:
    """Extrapolated events per device type and share per company (AGG-21)."""
    return share_by(fct_event, ["company_id"], ["device_type"], "event_count",
                    "device_event_count", "device_share")


def events_per_company(fct_event: DataFrame) -> DataFrame:
    """Event rows per company, most first (AGG-09, SORT-01)."""
    return fct_event.groupBy("company_id").agg(F.count(F.lit(1)).alias("cnt")) \
        .orderBy(F.desc("cnt"), "company_id")


def ranked(rows: DataFrame, *order) -> DataFrame:
    """A sorted report with each row's place in its order as ``place``
    (SORT-01..03), so that the order itself is data. For reports of one row a
    group: the numbering is one task over the aggregated rows."""
    return rows.withColumn("place", F.row_number().over(Window.orderBy(*order)))


def top_companies(fct_event: DataFrame, k: int = 5) -> DataFrame:
    """Top-k companies by all-time conversion rate (TOPK-01). Ties broken by
    company id; the limit is the feature (a top-k report)."""
    t = company_totals(fct_event).select("company_id", "event_count", "consent_conversion_rate")
    return t.orderBy(F.col("consent_conversion_rate").desc_nulls_last(), "company_id").limit(k)


# --------------------------------------------------------------------------- profiles

def key_counts(df: DataFrame, keys: list[str], min_count: int = 1) -> DataFrame:
    """Rows per key, most first (AGG-07). ``min_count=2`` lists duplicates."""
    c = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))
    if min_count > 1:
        c = c.where(F.col("cnt") >= min_count)
    return c.orderBy(F.desc("cnt"), *keys)


def null_key_probes(raw: DataFrame, companies: DataFrame) -> DataFrame:
    """Null / empty key probes of the raw tables in one row (PRJ-19): missing
    or empty event ids, missing event times, missing company keys. One
    aggregate over a tagged union of the two (column-pruned) inputs."""
    def blank(c):
        return F.col(c).isNull() | (F.col(c) == "")
    no = F.lit(None).cast("boolean")
    ev = raw.select(F.lit("e").alias("t"), blank("EVENT_ID").alias("a"),
                    F.col("EVENT_TIME").isNull().alias("b"), blank("APIKEY").alias("c"),
                    no.alias("d"), no.alias("h"))
    co = companies.select(F.lit("c").alias("t"), no.alias("a"), no.alias("b"), no.alias("c"),
                          F.col("PUBLIC_API_KEY").isNull().alias("d"),
                          F.col("HQ_COUNTRY").isNull().alias("h"))
    u = ev.unionByName(co)
    is_e, is_c = F.col("t") == "e", F.col("t") == "c"
    return u.agg(
        F.count(F.when(is_e & F.col("a"), 1)).alias("missing_event_id"),
        F.count(F.when(is_e & F.col("b"), 1)).alias("missing_event_time"),
        F.count(F.when(is_e & F.col("c"), 1)).alias("missing_event_company"),
        F.count(F.when(is_e, 1)).alias("event_rows"),
        F.count(F.when(is_c & F.col("d"), 1)).alias("missing_company_key"),
        F.count(F.when(is_c & F.col("h"), 1)).alias("missing_hq_country"),
        F.count(F.when(is_c, 1)).alias("company_rows"))


def type_rate_consent_profile(raw: DataFrame) -> DataFrame:
    """Raw rows by type × rate × consent (AGG-08)."""
    return raw.groupBy(F.col("TYPE").alias("type"), F.col("RATE").alias("rate"),
                       F.col("CONSENT").alias("consent")) \
        .agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.desc("cnt"))


def user_type_counts(fct_event: DataFrame) -> DataFrame:
    """Event rows per user × type (AGG-10)."""
    return fct_event.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("cnt"))


def anomalous_consent(fct_event: DataFrame) -> DataFrame:
    """Suspicious status combinations (AGG-25): a non-empty status on an
    asked event, an empty status on a given event."""
    bad = (((F.col("event_type") == CONSENT_ASKED) & (F.col("consent_status") != "empty"))
           | ((F.col("event_type") == CONSENT_GIVEN) & (F.col("consent_status") == "empty")))
    return fct_event.where(bad).groupBy("event_type", "consent_status") \
        .agg(F.count(F.lit(1)).alias("cnt"))


def hq_gap_count(dim_company: DataFrame) -> DataFrame:
    """Companies without an HQ country (AGG-26), default member excluded."""
    real = dim_company.where(F.col("origin") != "n/a")
    return real.agg(F.count(F.when(F.col("hq_country") == "n/a", 1)).alias("missing_hq_count"),
                    F.count(F.lit(1)).alias("company_count"))


def hourly_given(fct_event: DataFrame) -> DataFrame:
    """consent.given rows per hour (AGG-11, SORT-02)."""
    hour = hour_start("event_dttm")
    return (fct_event.where(F.col("event_type") == CONSENT_GIVEN)
            .groupBy(hour.alias("hour_ts")).agg(F.count(F.lit(1)).alias("consent_given_count"))
            .orderBy("hour_ts"))


def hourly_asked_given(fct_event: DataFrame) -> DataFrame:
    """Extrapolated asked/given per hour (AGG-12)."""
    hour = hour_start("event_dttm")
    return (fct_event.where(F.col("event_type").isin(CONSENT_ASKED, CONSENT_GIVEN))
            .groupBy(hour.alias("hour_ts"), "event_type")
            .agg(F.sum("event_count").alias("cnt")).orderBy("hour_ts", "event_type"))


# --------------------------------------------------------------------------- report rollups

def industry_rate_of_sums(report: DataFrame) -> DataFrame:
    """Industry conversion as ratio of summed given / asked (AGG-13, SORT-03)."""
    s = report.groupBy("industry_front").agg(
        F.sum("event_consent_asked_count").alias("total_asked"),
        F.sum("event_consent_given_count").alias("total_given"))
    return s.withColumn("conversion_rate", conversion_rate("total_given", "total_asked")) \
        .orderBy(F.col("conversion_rate").asc_nulls_last())


def industry_avg_rate(report: DataFrame) -> DataFrame:
    """Industry conversion as the average of daily rates (AGG-14; differs from
    the ratio of sums, trap D20)."""
    # exact mean (decimal(24,2) / decimal(12,0) keeps 15 digits), rounded once
    rate = F.col("consent_conversion_rate")
    mean = F.sum(rate).cast("decimal(24,2)") / F.count(rate).cast("decimal(12,0)")
    return report.groupBy("industry_front").agg(
        F.round(mean, 3).alias("avg_conversion_rate"),
        F.sum("event_consent_asked_count").alias("total_asked"),
        F.sum("event_consent_given_count").alias("total_given"),
    ).orderBy(F.col("avg_conversion_rate").desc_nulls_first())


def hq_totals(report: DataFrame, min_asked: float | None = None) -> DataFrame:
    """Asked / given per HQ country (AGG-15), optional HAVING on asked."""
    s = report.groupBy("hq_country").agg(
        F.sum("event_consent_asked_count").alias("asked"),
        F.sum("event_consent_given_count").alias("given"))
    if min_asked is not None:
        s = s.where(F.col("asked") > min_asked)
    return s.orderBy(F.col("asked").asc_nulls_last())


# --------------------------------------------------------------------------- raw-level

def raw_volume(raw: DataFrame) -> DataFrame:
    """Unrounded extrapolated volume per company and day (AGG-16, PRJ-17)."""
    return raw.groupBy(F.col("APIKEY").alias("company_id"),
                       F.to_date("EVENT_TIME").alias("event_dt")) \
        .agg(F.sum(F.col("COUNT") / F.col("RATE")).alias("raw_event_count"),
             F.count(F.lit(1)).alias("raw_rows"))


def raw_volume_total(raw: DataFrame) -> DataFrame:
    """Unrounded extrapolated volume over all raw events (AGG-16)."""
    return raw.agg(F.sum(F.col("COUNT") / F.col("RATE")).alias("raw_event_count"), F.count(F.lit(1)).alias("raw_rows"))


def raw_volume_at(raw: DataFrame, company_id: str, day, country: str) -> DataFrame:
    """Unrounded volume of one company on one day (PRJ-17), and of its events
    whose raw country is the *quoted* text ``"<country>"`` (PRJ-22)."""
    here = raw.where((F.col("APIKEY") == company_id) & (F.to_date("EVENT_TIME") == F.lit(day)))
    volume = F.col("COUNT") / F.col("RATE")
    quoted = F.col("COUNTRY") == F.lit(f'"{country}"')
    return here.agg(F.sum(volume).alias("raw_event_count"), F.count(F.lit(1)).alias("raw_rows"),
                    F.sum(F.when(quoted, volume)).alias("country_event_count"), F.count(F.when(quoted, 1)).alias("country_rows"))


def company_statuses(fct_event: DataFrame) -> DataFrame:
    """Each company's list of consent statuses unpacked again, one row each
    with its place in the list (FN-21)."""
    lists = fct_event.groupBy("company_id").agg(F.sort_array(F.collect_set("consent_status")).alias("statuses"))
    return lists.select("company_id", F.posexplode("statuses").alias("place", "consent_status"))


def known_countries(fct_event: DataFrame, dim_country: DataFrame) -> DataFrame:
    """Distinct event country codes present in the country reference (JOIN-05,
    compared on the alpha code, trap D19)."""
    codes = fct_event.select("country_code").distinct()
    return codes.join(dim_country.select("country_code"), "country_code", "left_semi")


def unknown_countries(fct_event: DataFrame, dim_country: DataFrame) -> DataFrame:
    codes = fct_event.select("country_code").distinct()
    return codes.join(dim_country.select("country_code"), "country_code", "left_anti")


def orphan_companies(fct_event: DataFrame, dim_company: DataFrame) -> DataFrame:
    """Event companies missing from the company reference (JOIN-09)."""
    ids = fct_event.select("company_id").distinct()
    return ids.join(dim_company.select("company_id"), "company_id", "left_anti")


def idle_companies(fct_event: DataFrame, dim_company: DataFrame) -> DataFrame:
    """Reference companies without any event (anti join the other way)."""
    return (dim_company.where(F.col("origin") != "n/a")
            .select("company_id", "industry_front", "hq_country")
            .join(fct_event.select("company_id").distinct(), "company_id", "left_anti"))


def events_with_industry(fct_event: DataFrame, dim_company: DataFrame) -> DataFrame:
    """Event fact ⟕ company (JOIN-06), row by row: the frequent companies are
    salted (``salted_join``)."""
    comp = dim_company.select("company_id", "industry_back", "industry_front")
    return salted_join(fct_event.select("event_id", "company_id", "event_type", "event_count"), comp, "company_id", ["event_id"])


def events_as_of(fct_event: DataFrame, versions: DataFrame) -> DataFrame:
    """Events with their company's attributes of the event's own time (JOIN-04)."""
    return as_of(fct_event.select("event_id", "company_id", "event_dttm", "event_type"), versions, "company_id",
                 "event_dttm", ["industry_front", "hq_country"], "event_id")


def events_by_country(fct_event: DataFrame, dim_country: DataFrame) -> DataFrame:
    """Event fact ⟕ country dimension through ``country_fk`` (JOIN-08), rolled
    up per country. Events are added up by their country key first (a partial
    aggregate), so the join sees one row per key and no key is hot."""
    by_key = fct_event.groupBy("country_fk", "country_code").agg(
        F.count(F.lit(1)).alias("event_rows"), F.sum("event_count").alias("event_count"))
    dc = dim_country.select("country_sk", "country_name", "region")
    j = by_key.join(dc, by_key.country_fk == dc.country_sk, "left")
    return j.groupBy("country_code", "country_name", "region").agg(
        F.sum("event_rows").alias("event_rows"), F.sum("event_count").alias("event_count"))


def distinct_event_types(fct_event: DataFrame) -> DataFrame:
    """DISTINCT event type × consent status (AGG-17)."""
    return fct_event.select("event_type", "consent_status").distinct()


def table_counts(raw: DataFrame, fct_event: DataFrame, fct_consent: DataFrame,
                 report: DataFrame) -> DataFrame:
    """Side-by-side row counts in one row (AGG-19, SRC-28): one aggregate
    over a tagged union (each input is pruned to a constant column)."""
    tagged = [df.select(F.lit(name).alias("t")) for df, name in (
        (raw, "raw_events"), (fct_event, "fct_event"), (fct_consent, "fct_consent"),
        (report, "consent_company_day"))]
    u = tagged[0]
    for t in tagged[1:]:
        u = u.unionAll(t)
    names = ["raw_events", "fct_event", "fct_consent", "consent_company_day"]
    return u.agg(*[F.count(F.when(F.col("t") == n, 1)).alias(n) for n in names])


def report_preview(report: DataFrame, n: int = 10) -> DataFrame:
    """First rows of the report in key order (LIM-01)."""
    return report.orderBy("consent_uq").limit(n)
