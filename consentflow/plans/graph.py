"""The model graph over one input directory, built lazily.

Each attribute is a DataFrame whose plan reaches back to the Parquet scans,
so Catalyst sees the whole chain (pruning the columns and operators a
consumer does not use). Writers in ``consentflow.operators.incremental``
materialise any node to a table.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from consentflow.operators.window_bounds import LoadWindow
from consentflow.plans import mart, report, staging
from consentflow.sources import driver_tables


@dataclass
class ModelGraph:
    spark: SparkSession
    sf_dir: str
    window: LoadWindow | None = None
    run_id: str | None = None

    # raw
    @cached_property
    def raw_events(self) -> DataFrame:
        return driver_tables.raw_events(self.spark, self.sf_dir)

    @cached_property
    def raw_companies(self) -> DataFrame:
        return driver_tables.raw_companies(self.spark, self.sf_dir)

    @cached_property
    def country_seed(self) -> DataFrame:
        return driver_tables.country_seed(self.spark, self.sf_dir)

    # staging
    @cached_property
    def stg_event(self) -> DataFrame:
        return staging.stg_event(self.raw_events, self.window, self.run_id)

    @cached_property
    def stg_company(self) -> DataFrame:
        return staging.stg_company(self.raw_companies)

    @cached_property
    def stg_country(self) -> DataFrame:
        return staging.stg_country(self.country_seed)

    @cached_property
    def stg_date(self) -> DataFrame:
        return staging.stg_date(self.spark)

    # mart
    @cached_property
    def fct_event(self) -> DataFrame:
        return mart.fct_event(self.stg_event)

    @cached_property
    def consent_events(self) -> DataFrame:
        """Event rows with the next event of the same user and the asked→given
        gap (skew-safe sequence); shared by the time-to-consent queries."""
        return staging.consent_events(self.fct_event, self.window)

    @cached_property
    def stg_consent(self) -> DataFrame:
        return staging.stg_consent(self.fct_event, self.window, self.run_id)

    @cached_property
    def fct_consent(self) -> DataFrame:
        return mart.fct_consent(self.stg_consent)

    @cached_property
    def dim_company(self) -> DataFrame:
        return mart.dim_company(self.stg_company, self.run_id)

    @cached_property
    def dim_country(self) -> DataFrame:
        return mart.dim_country(self.stg_country, self.run_id)

    @cached_property
    def dim_date(self) -> DataFrame:
        return mart.dim_date(self.stg_date, self.run_id)

    # report
    @cached_property
    def consent_company_day(self) -> DataFrame:
        return report.consent_company_day(self.fct_consent, self.dim_company, self.dim_date,
                                          self.window, self.run_id)

    def report_keep_unmatched(self) -> DataFrame:
        return report.consent_company_day(self.fct_consent, self.dim_company, self.dim_date,
                                          self.window, self.run_id, keep_unmatched=True)
