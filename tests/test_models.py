"""Model tests: the consent model against sums by hand, calendar attributes,
key traps (D3, D4), whole-day windows (D2), inner vs unmatched report (D5)."""

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from consentflow.functions.defaults import SURROGATE_NULL_TOKEN
from consentflow.operators.window_bounds import LoadWindow
from consentflow.plans import analysis, mart, report, staging
from consentflow.sources.schemas import RAW_EVENT_SCHEMA

FCT_EVENT_DDL = ("event_id string, event_type string, event_count double, event_dttm timestamp_ntz, "
                 "user_id string, company_id string, consent_status string")


def md5(s):
    return hashlib.md5(s.encode()).hexdigest()


def fct_rows(spark, rows):
    return spark.createDataFrame(rows, FCT_EVENT_DDL)


def test_stg_consent_by_hand(spark):
    """Several users, days, types and statuses, ties and an absent type,
    against sums written out in Python."""
    day = lambda d, h, m=0: dt.datetime(2031, 6, d, h, m)
    rows = [
        ("x1", "consent.asked", 4.0, day(3, 8), "ann", "north", "empty"),
        ("x2", "consent.given", 1.0, day(3, 8, 7), "ann", "north", "opt-out"),
        ("x3", "consent.asked", 6.0, day(3, 8, 7), "bo", "north", "empty"),
        ("x4", "consent.given", 2.0, day(3, 8, 7), "bo", "north", "partial opt-in"),  # same instant, later id
        ("x5", "pageview", 30.0, day(3, 9), "bo", "north", None),
        ("x6", "consent.asked", 5.0, day(3, 23, 59), "ann", "north", "empty"),
        ("x7", "consent.given", 1.0, day(4, 0, 1), "ann", "north", "full opt-in"),  # next day: other row
        ("x8", "consent.given", 3.0, day(3, 10), "cy", "south", "empty"),
        ("x9", "consent.asked", 8.0, day(3, 9), "cy", "south", None),
    ]
    out = {(r.company_id, r.event_dt.day): r for r in staging.stg_consent(fct_rows(spark, rows), with_lag=True).collect()}
    assert set(out) == {("north", 3), ("north", 4), ("south", 3)}
    for (company, d), r in out.items():
        own = [x for x in rows if x[5] == company and x[3].day == d]

        def total(kind=None, status=None):
            counts = [x[2] for x in own if kind in (None, x[1]) and status in (None, x[6])]
            return sum(counts) if counts else None
        assert r.event_count == total() and r.event_pageview_count == total("pageview")
        assert r.event_consent_asked_count == total("consent.asked") and r.event_consent_given_count == total("consent.given")
        assert r.event_ui_action_count is None
        for column, status in (("full_opt_in", "full opt-in"), ("opt_out", "opt-out"), ("partial_opt_in", "partial opt-in"), ("empty", "empty")):
            assert r[f"consent_given_{column}_count"] == total("consent.given", status)
        assert r.consent_uq == md5(f"{company}-2031-06-0{d}") and r.date_fk == md5(f"2031-06-0{d}") and r.origin == "fct_event"
    assert str(out["north", 3].consent_conversion_rate) == "0.20"
    assert out["north", 4].consent_conversion_rate is None
    # asked at 8:00 answered after 7 min; 8:07 at once; 23:59 after 2 min, on the next day
    assert out["north", 3].lag_consent_asked_given_second_avg == (420 + 0 + 120) / 3
    assert out["south", 3].lag_consent_asked_given_second_avg == 3600.0


def test_window_pruned_when_lag_not_requested(spark):
    ev = fct_rows(spark, [("e1", "pageview", 1.0, dt.datetime(2025, 5, 1), "u1", "c1", "empty")])
    plan = staging.stg_consent(ev)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_whole_day_window_keeps_end_day(spark):
    """Trap D2: the end day is processed whole, not just its midnight."""
    ev = fct_rows(spark, [
        ("a", "pageview", 1.0, dt.datetime(2025, 5, 2, 0, 0), "u", "c", "empty"),
        ("b", "pageview", 1.0, dt.datetime(2025, 5, 2, 23, 59, 59), "u", "c", "empty"),
        ("c", "pageview", 1.0, dt.datetime(2025, 5, 3, 0, 0), "u", "c", "empty"),
        ("d", "pageview", 1.0, dt.datetime(2025, 4, 30, 23, 59, 59), "u", "c", "empty"),
    ])
    out = staging.stg_consent(ev, LoadWindow(dt.date(2025, 5, 1), dt.date(2025, 5, 2))).collect()
    assert [(r.event_dt, r.event_count) for r in out] == [(dt.date(2025, 5, 2), 2.0)]


def test_window_bound_expressions(spark):
    from consentflow.operators.window_bounds import resolve_bound
    import pytest
    df = spark.range(1).select(resolve_bound("2025-01-31").alias("a"),
                               resolve_bound("date '2025-02-01' - 1").alias("b"),
                               resolve_bound("current_date").alias("c"))
    r = df.first()
    assert r.a == dt.date(2025, 1, 31) and r.b == dt.date(2025, 1, 31) and r.c is not None
    with pytest.raises(ValueError):
        resolve_bound("yesterday")


def raw_event(spark, **over):
    base = dict(EVENT_ID="e1", USER_ID="u1", TYPE="pageview", RATE=0.1, PARAMETERS="{}",
                EVENT_TIME=dt.datetime(2025, 9, 5, 1, 14, 29, 602000),
                WINDOW_START=dt.datetime(2025, 9, 5, 1), APIKEY="c1", CONSENT="empty", COUNT=10,
                EXPERIMENT=None, SDK_TYPE="sdk-web", DOMAIN="service1.org", DEPLOYMENT_ID="d",
                COUNTRY='"ES"', REGION='"CM"', BROWSER_FAMILY="Chrome", DEVICE_TYPE="desktop")
    base.update(over)
    df = spark.createDataFrame([tuple(base[f.name] for f in RAW_EVENT_SCHEMA.fields)], RAW_EVENT_SCHEMA)
    return df.select("*", F.current_timestamp().alias("load_time"), F.lit("x").alias("load_no"),
                     F.lit("f.csv").alias("filename"))


def test_stg_event_keys_and_cleaning(spark):
    r = staging.stg_event(raw_event(spark)).first()
    assert r.country_code == "ES" and r.region_code == "CM"
    assert r.event_count == 100.0 and r.sample_count == 10
    assert r.event_uq == md5("e1-2025-09-05")
    assert r.company_fk == md5("c1") and r.date_fk == md5("2025-09-05")
    # trap D3: the country key hashes the unquoted code, so it meets dim_country
    assert r.country_fk == md5("ES")
    assert r.origin == "f.csv" and r.update_dttm is None


def test_stg_date_calendar(spark):
    d = staging.stg_date(spark, dt.date(2020, 12, 28), dt.date(2021, 1, 10))
    rows = {r.date_day: r for r in d.collect()}
    sun = rows[dt.date(2021, 1, 3)]
    assert sun.week_no == 53 and sun.day_of_week == 0 and sun.is_weekend and not sun.is_workday
    assert sun.day_name == "Sunday" and sun.month_name == "January"
    assert sun.week_start == dt.date(2020, 12, 28) and sun.week_end == dt.date(2021, 1, 3)
    mon = rows[dt.date(2021, 1, 4)]
    assert mon.week_no == 1 and mon.day_of_week == 1 and mon.is_workday
    assert mon.month_start == dt.date(2021, 1, 1) and mon.month_end == dt.date(2021, 1, 31)
    sat = rows[dt.date(2021, 1, 9)]
    assert sat.day_of_week == 6 and sat.is_weekend
    assert len(rows) == 14
    leap = staging.stg_date(spark, dt.date(2024, 2, 29), dt.date(2024, 2, 29)).first()
    assert leap.month_end == dt.date(2024, 2, 29) and leap.day_of_year == 60
    padded = staging.stg_date(spark, dt.date(2021, 1, 3), dt.date(2021, 1, 3), pad_names=True).first()
    assert padded.day_name == "Sunday   " and padded.month_name == "January  "


def test_full_spine_and_default_date_member(spark):
    dd = mart.build_dim_date(spark)
    assert dd.count() == 36890 + 1
    default = dd.where(F.col("date_day") == dt.date(1900, 1, 1)).first()
    assert default.date_sk == md5("1900-01-01")  # trap D4: not md5('1898')
    assert default.year == 0 and default.day_name == "n/a" and default.is_workday is False


def test_company_default_row_and_trim(spark):
    raw = spark.createDataFrame([(" k1 ", " Media ", "Media", None, "f.csv")],
                                "PUBLIC_API_KEY string, INDUSTRY_BACK string, INDUSTRY_FRONT string, "
                                "HQ_COUNTRY string, filename string")
    dim = mart.dim_company(staging.stg_company(raw))
    rows = {r.company_id: r for r in dim.collect()}
    assert set(rows) == {"k1", "n/a"}
    assert rows["k1"].industry_back == "Media" and rows["k1"].hq_country == "n/a"
    assert rows["k1"].company_sk == md5("k1")
    assert rows["n/a"].origin == "n/a"
    assert rows["k1"].valid_to == dt.datetime(9999, 12, 31)


def test_report_inner_vs_keep_unmatched(spark):
    """Trap D5: a fact whose company is unknown drops out of the report, unless
    keep_unmatched points it at the default member."""
    ev = fct_rows(spark, [
        ("e1", "consent.asked", 10.0, dt.datetime(2025, 5, 1, 10), "u1", "known", None),
        ("e2", "consent.given", 1.0, dt.datetime(2025, 5, 1, 11), "u1", "known", "opt-out"),
        ("e3", "pageview", 3.0, dt.datetime(2025, 5, 1, 12), "u2", "ghost", "empty"),
    ])
    fc = mart.fct_consent(staging.stg_consent(ev))
    comp = mart.dim_company(staging.stg_company(spark.createDataFrame(
        [("known", "B", "Gaming", "Spain", "f")],
        "PUBLIC_API_KEY string, INDUSTRY_BACK string, INDUSTRY_FRONT string, HQ_COUNTRY string, filename string")))
    dd = mart.build_dim_date(spark)
    inner = report.consent_company_day(fc, comp, dd).collect()
    assert [(r.company_id, r.industry_front, r.is_workday) for r in inner] == [("known", "Gaming", True)]
    assert float(inner[0].consent_conversion_rate) == 0.1
    keep = {r.company_id: r for r in report.consent_company_day(fc, comp, dd, keep_unmatched=True).collect()}
    assert keep["ghost"].industry_front == "n/a" and keep["ghost"].date_day == dt.date(2025, 5, 1)


def test_rate_of_sums_differs_from_average_of_rates(spark):
    """Trap D20: both industry rates exist and differ."""
    rep = spark.createDataFrame([("G", 100.0, 10.0, 0.10), ("G", 10.0, 9.0, 0.90)],
                                "industry_front string, event_consent_asked_count double, "
                                "event_consent_given_count double, consent_conversion_rate double") \
        .withColumn("consent_conversion_rate", F.col("consent_conversion_rate").cast("decimal(23,2)"))
    ros = analysis.industry_rate_of_sums(rep).first()
    avg = analysis.industry_avg_rate(rep).first()
    assert float(ros.conversion_rate) == 0.17 and float(avg.avg_conversion_rate) == 0.5


def test_sequence_runs_inside_the_load_window(spark):
    """Trap D6: the successor is looked up among the window's events only, so
    an asked event on the window's last day followed by a given just after
    midnight has no matched gap; a window covering both days matches it."""
    ev = fct_rows(spark, [
        ("e1", "consent.asked", 1.0, dt.datetime(2025, 5, 1, 23, 59), "u1", "c1", None),
        ("e2", "consent.given", 1.0, dt.datetime(2025, 5, 2, 0, 1), "u1", "c1", "full opt-in"),
    ])
    one_day = staging.consent_events(ev, LoadWindow(dt.date(2025, 5, 1), dt.date(2025, 5, 1))).collect()
    assert [r.lag_consent_asked_given_second for r in one_day] == [None]
    both = staging.consent_events(ev, LoadWindow(dt.date(2025, 5, 1), dt.date(2025, 5, 2)))
    assert both.where("event_id = 'e1'").first().lag_consent_asked_given_second == 120
