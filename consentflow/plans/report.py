"""Report model: the dashboard-ready company × day consent table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from consentflow.functions import DATE_MIN, ORIGIN_REPORT, default_int, default_string
from consentflow.operators import window_bounds
from consentflow.operators.as_of import as_of
from consentflow.plans import staging

REPORT_COLUMNS = [
    "consent_uq", "date_day", "is_workday", "year", "month", "week_no",
    "industry_front", "hq_country", "company_id", *staging.METRIC_COLUMNS,
    "run_id", "ingest_dttm", "update_dttm", "origin",
]


def _current(dim: DataFrame) -> DataFrame:
    """Members valid today (point-in-time lookup; folds to a constant for the
    open-ended validity of unversioned dimensions)."""
    today = F.current_date().cast("timestamp_ntz")
    return dim.where((F.col("valid_from") <= today) & (today <= F.col("valid_to")))


def consent_company_day(fct_consent: DataFrame, dim_company: DataFrame, dim_date: DataFrame,
                        window: window_bounds.LoadWindow | None = None,
                        run_id: str | None = None, keep_unmatched: bool = False) -> DataFrame:
    """Consent fact enriched with calendar and company attributes of today (for
    those of the fact's own day see ``consent_as_of``).

    Default: facts without a current company / date member drop out (the
    validity filter after the outer joins makes them inner joins, trap D5).
    ``keep_unmatched`` keeps such facts and points them at the default member.

    Both joins are unhinted: the fact is already one row per company and day,
    and size estimates and AQE choose between broadcast and sort-merge.
    """
    cons = window_bounds.apply(fct_consent, window, "event_dt", "date")
    comp = _current(dim_company).select("company_sk", "industry_front", "hq_country")
    d = _current(dim_date).select("date_sk", "date_day", "is_workday", "year", "month", "week_no")
    how = "left" if keep_unmatched else "inner"
    j = (cons.join(comp, cons.company_fk == comp.company_sk, how)
         .join(d, cons.date_fk == d.date_sk, how))
    if keep_unmatched:
        # unmatched facts point at the default members' attribute values
        zero = default_int().cast("int")
        defaults = {"industry_front": default_string(), "hq_country": default_string(),
                    "date_day": F.lit(DATE_MIN), "is_workday": F.lit(False),
                    "year": zero, "month": zero, "week_no": zero}
        j = j.withColumns({c: F.coalesce(F.col(c), v) for c, v in defaults.items()})
    return j.select(
        "consent_uq", "date_day", "is_workday", "year", "month", "week_no",
        "industry_front", "hq_country", "company_id", *staging.METRIC_COLUMNS,
        F.lit(run_id or "local").alias("run_id"),
        F.current_timestamp().alias("ingest_dttm"),
        F.lit(None).cast("timestamp_ntz").alias("update_dttm"),
        F.lit(ORIGIN_REPORT).alias("origin"))


def consent_as_of(fct_consent: DataFrame, company_versions: DataFrame) -> DataFrame:
    """Company-day facts with the company attributes valid on the fact's own day
    (JOIN-04): history keeps the attributes it had, facts of a day without a
    valid version stay with nulls. Both ends of a validity count."""
    facts = fct_consent.select("consent_uq", "company_id", "event_dt", F.col("event_dt").cast("timestamp_ntz").alias("at"),
                               "event_count", "consent_conversion_rate")
    return as_of(facts, company_versions, "company_id", "at", ["industry_front", "hq_country"], "consent_uq").drop("at")
