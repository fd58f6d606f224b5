"""End to end: files → load → build (first run, then incremental backfills)
→ checks; the incremental result equals a single full build."""

import datetime as dt

from pyspark.sql import functions as F

from consentflow.operators.window_bounds import LoadWindow
from consentflow.plans.graph import ModelGraph
from consentflow.sources import roundtrip
from consentflow.sources.schemas import RAW_EVENT_SCHEMA
from consentflow.warehouse import Warehouse
from tests.conftest import SF_SMALL

REPORT_KEYS = ["consent_uq", "company_id", "date_day", "event_count", "event_consent_asked_count",
               "event_consent_given_count", "consent_conversion_rate", "industry_front", "hq_country"]


def _files(spark, tmp_dir):
    g = ModelGraph(spark, SF_SMALL)
    raw = g.raw_events
    early = raw.where(F.col("EVENT_TIME") < F.lit(dt.datetime(2024, 1, 15)))
    late = raw.where(F.col("EVENT_TIME") >= F.lit(dt.datetime(2024, 1, 15)))
    roundtrip.export_raw(early, f"{tmp_dir}/in1")
    roundtrip.export_raw(late, f"{tmp_dir}/in2")
    g.raw_companies.drop("load_time", "load_no", "filename").coalesce(1).write \
        .option("header", True).csv(f"{tmp_dir}/company")
    g.country_seed.coalesce(1).write.option("header", True).csv(f"{tmp_dir}/seed")
    return g


def test_load_build_incremental_equals_full(spark, tmp_dir):
    g = _files(spark, tmp_dir)
    wh = Warehouse(spark, f"{tmp_dir}/wh")
    wh.seed_countries(f"{tmp_dir}/seed/*.csv")
    wh.load_companies(f"{tmp_dir}/company/*.csv")
    r1 = wh.load_events(f"{tmp_dir}/in1/*/part-*", schema=RAW_EVENT_SCHEMA)
    assert r1.loaded and not r1.failed
    assert wh.build()["fct_event"] == "full"
    assert wh.violations == {"not_null_consent_uq": 0, "is_positive_event_count": 0, "not_empty_consent_company_day": 0}
    # second file batch arrives; backfill its days, one of them twice
    wh.load_events(f"{tmp_dir}/in*/*/part-*", schema=RAW_EVENT_SCHEMA)
    for w in (LoadWindow(dt.date(2024, 1, 14), dt.date(2024, 1, 22)),
              LoadWindow(dt.date(2024, 1, 20), dt.date(2024, 1, 31)),
              LoadWindow(dt.date(2024, 1, 20), dt.date(2024, 1, 31))):
        assert wh.build(w)["fct_event"] == "key-replaced"
        assert wh.violations == {"not_null_consent_uq": 0, "is_positive_event_count": 0}
    some = g.consent_company_day.where(F.col("date_day").between(dt.date(2024, 1, 20), dt.date(2024, 1, 31))).first()
    wrong = [({"company_id": some.company_id, "date_day": some.date_day}, "event_count", -1.0),
             ({"company_id": "none"}, "event_count", 1.0)]
    wh.build(LoadWindow(dt.date(2024, 1, 20), dt.date(2024, 1, 31)), expected=wrong)
    assert wh.violations["expected_0"] == 1 and wh.violations["expected_1"] == 0  # the second is not of this window
    wh.build(LoadWindow(dt.date(1999, 1, 1), dt.date(1999, 1, 2)))  # a window without rows
    assert wh.violations == {"not_null_consent_uq": 0, "is_positive_event_count": 0}
    got = wh.read("report", "consent_company_day").select(*REPORT_KEYS)
    want = g.consent_company_day.select(*REPORT_KEYS)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert wh.read("mart", "fct_event").count() == g.fct_event.count()
    assert all(v == 0 for v in wh.test().values())
    import pytest
    from consentflow.warehouse import DataCheckError
    key = {"company_id": "0", "date_day": dt.date(2024, 1, 5)}
    with pytest.raises(DataCheckError):
        wh.test(expected=[(key, "event_count", -1.0)], raise_on_failure=True)
    cat = {(r.table_name, r.column_name) for r in wh.catalog().collect()}
    assert ("consent_company_day", "consent_conversion_rate") in cat and ("dim_date", "week_no") in cat

    # schema-qualified SQL over the registered layers
    tables = wh.register(prefix="t_")
    assert "t_report.consent_company_day" in tables and "t_mart.fct_event" in tables
    n_report = spark.sql("select count(*) from t_report.consent_company_day").first()[0]
    assert n_report == want.count()
    by_sql = spark.sql("""
        select industry_front,
               round(cast(sum(event_consent_given_count) as decimal(20,0))
                     / cast(sum(event_consent_asked_count) as decimal(20,0)), 2) as conversion_rate
        from t_report.consent_company_day group by industry_front""")
    from consentflow.plans import analysis
    by_api = analysis.industry_rate_of_sums(wh.read("report", "consent_company_day")) \
        .select("industry_front", "conversion_rate")
    assert by_sql.exceptAll(by_api).count() == 0 and by_api.exceptAll(by_sql).count() == 0
    hourly = spark.sql("""select date_trunc('hour', event_dttm) as hour_ts, count(*) as n
                          from t_mart.fct_event where event_type = 'consent.given' group by 1""")
    assert hourly.agg(F.sum("n")).first()[0] == g.fct_event.where("event_type = 'consent.given'").count()


def test_raw_window_prunes_partitions(spark, tmp_dir):
    _files(spark, tmp_dir)
    wh = Warehouse(spark, f"{tmp_dir}/wh")
    wh.load_events(f"{tmp_dir}/in*/*/part-*", schema=RAW_EVENT_SCHEMA)
    w = LoadWindow(dt.date(2024, 1, 10), dt.date(2024, 1, 12))
    raw = wh.read("raw", "events").where(w.on_date("EVENT_DATE"))
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(EVENT_DATE" in plan
    assert raw.select("EVENT_DATE").distinct().count() == 3


def test_default_incremental_window_is_yesterday_to_today(spark, tmp_dir):
    """A run without a window on an existing fact uses the default window;
    the test data lies in the past, so the facts stay as they are."""
    g = _files(spark, tmp_dir)
    wh = Warehouse(spark, f"{tmp_dir}/wh")
    wh.seed_countries(f"{tmp_dir}/seed/*.csv")
    wh.load_companies(f"{tmp_dir}/company/*.csv")
    wh.load_events(f"{tmp_dir}/in*/*/part-*", schema=RAW_EVENT_SCHEMA)
    assert wh.build()["fct_event"] == "full"
    before = wh.read("mart", "fct_event").count()
    assert wh.build()["fct_event"] == "key-replaced"
    assert wh.read("mart", "fct_event").count() == before == g.fct_event.count()
    assert wh.build(full_refresh=True)["fct_event"] == "full"


def test_partitioned_table_schema_drift(spark, tmp_dir):
    from consentflow.warehouse import PartitionedTable
    t = PartitionedTable(spark, f"{tmp_dir}/t", "event_dt")
    d1, d2 = dt.date(2025, 1, 1), dt.date(2025, 1, 2)
    t.overwrite(spark.createDataFrame([("a", d1, 1), ("b", d2, 2)], "k string, event_dt date, v int"))
    t.key_replace(spark.createDataFrame([("b", d2, 20, "new")], "k string, event_dt date, v int, extra string"),
                  ["k"])
    rows = {r.k: r for r in t.read().collect()}
    assert rows["a"].extra is None and rows["b"].extra == "new" and rows["b"].v == 20


def test_key_replace_reads_only_batch_partitions(spark, tmp_dir):
    from consentflow.warehouse import PartitionedTable
    t = PartitionedTable(spark, f"{tmp_dir}/t", "event_dt")
    days = [dt.date(2025, 1, d) for d in range(1, 11)]
    t.overwrite(spark.createDataFrame([(f"k{i}", days[i % 10], i) for i in range(100)],
                                      "k string, event_dt date, v int"))
    batch = spark.createDataFrame([("k3", days[3], 300), ("new", days[4], 1)], "k string, event_dt date, v int")
    current = t.read().where(F.col("event_dt").isin(days[3], days[4]))
    plan = current._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [event_dt" in plan and "IN (2025-01-04,2025-01-05)" in plan
    t.key_replace(batch, ["k"])
    rows = {r.k: r.v for r in t.read().collect()}
    assert len(rows) == 101 and rows["k3"] == 300 and rows["new"] == 1 and rows["k13"] == 13
