"""The reference's data checks, each with a passing and a failing fixture."""

import datetime as dt

from consentflow.plans import checks

DDL = "consent_uq string, company_id string, date_day date, event_count double"
D = dt.date(2025, 9, 5)


def rep(spark, rows):
    return spark.createDataFrame(rows, DDL)


def test_unique(spark):
    ok = rep(spark, [("a", "c", D, 1.0), ("b", "c", D, 2.0), (None, "c", D, 1.0), (None, "c", D, 1.0)])
    assert checks.check_unique(ok, "consent_uq").count() == 0  # nulls ignored
    bad = rep(spark, [("a", "c", D, 1.0), ("a", "c", D, 2.0)])
    assert [tuple(r) for r in checks.check_unique(bad, "consent_uq").collect()] == [("a", 2)]


def test_not_null(spark):
    assert checks.check_not_null(rep(spark, [("a", "c", D, 1.0)]), "consent_uq").count() == 0
    assert checks.check_not_null(rep(spark, [(None, "c", D, 1.0)]), "consent_uq").count() == 1


def test_positive(spark):
    df = rep(spark, [("a", "c", D, 0.0), ("b", "c", D, -1.0), ("c", "c", D, None), ("d", "c", D, 3.0)])
    assert sorted(r.val for r in checks.check_positive(df, "event_count").collect()) == [-1.0, 0.0]


def test_not_empty(spark):
    assert checks.check_not_empty(rep(spark, [("a", "c", D, 1.0)])).count() == 0
    assert [r.row_count for r in checks.check_not_empty(rep(spark, [])).collect()] == [0]


def test_expected_value_mismatch_missing_duplicate(spark):
    key = {"company_id": "c", "date_day": D}
    good = rep(spark, [("a", "c", D, 4321.0)])
    assert checks.check_expected(good, key, "event_count", 4321).count() == 0
    wrong = rep(spark, [("a", "c", D, 4320.0)])
    assert [r.problem for r in checks.check_expected(wrong, key, "event_count", 4321).collect()] == ["mismatch"]
    # trap D23: the plain test passes on a missing row; ours reports it
    missing = rep(spark, [("a", "other", D, 1.0)])
    assert [r.problem for r in checks.check_expected(missing, key, "event_count", 4321).collect()] == ["missing"]
    dup = rep(spark, [("a", "c", D, 4321.0), ("b", "c", D, 4321.0)])
    assert [r.problem for r in checks.check_expected(dup, key, "event_count", 4321).collect()] == ["duplicate"]


def test_reconcile_tolerates_rounding_only(spark):
    raw = spark.createDataFrame(
        [("c", dt.datetime(2025, 9, 5, 1), 1, 0.4), ("c", dt.datetime(2025, 9, 5, 2), 3, 0.4)],
        "APIKEY string, EVENT_TIME timestamp_ntz, COUNT long, RATE double")
    # rounded: 2 + 8 = 10; unrounded 2.5 + 7.5 = 10 → pass; a wrong total fails
    ok = spark.createDataFrame([("c", D, 10.0)], "company_id string, date_day date, event_count double")
    assert checks.reconcile_raw_report(raw, ok).count() == 0
    bad = spark.createDataFrame([("c", D, 12.0)], "company_id string, date_day date, event_count double")
    assert checks.reconcile_raw_report(raw, bad).count() == 1


def test_observed_checks_agree_with_the_checks(spark):
    schema = "k string, day string, n double"
    rows = [("a", "d1", 3.0), (None, "d1", 0.0), ("b", "d2", -1.0), ("c", None, None), (None, "d3", 2.0)]
    expected = [({"k": "a", "day": "d1"}, "n", 3.0), ({"k": "b"}, "n", 3.0), ({"k": "c", "day": None}, "n", 1.0), ({"k": "z"}, "n", 1.0)]
    df = spark.createDataFrame(rows, schema)
    for whole in (True, False):
        w = checks.ObservedChecks("k", "n", expected, whole)
        assert w.watch(df).count() == len(rows)
        got = w.violations()
        assert got["not_null_k"] == checks.check_not_null(df, "k").count() == 2
        assert got["is_positive_n"] == checks.check_positive(df, "n").count() == 2
        assert [got[f"expected_{i}"] for i in range(4)] == [0, 1, 1, int(whole)]
        assert got.get("not_empty_consent_company_day") == (0 if whole else None)
    empty = checks.ObservedChecks("k", "n")
    assert empty.watch(df.where("false")).count() == 0
    assert empty.violations() == {"not_null_k": 0, "is_positive_n": 0, "not_empty_consent_company_day": 1}
