"""Data checks: each returns the violating rows (empty DataFrame = pass)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def check_unique(df: DataFrame, col: str) -> DataFrame:
    """Values of ``col`` occurring more than once (nulls ignored) (CHK-01)."""
    return (df.where(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    """Rows whose ``col`` is null (CHK-02)."""
    return df.where(F.col(col).isNull())


def check_positive(df: DataFrame, col: str) -> DataFrame:
    """Values ``<= 0`` (nulls pass) (CHK-03)."""
    return df.where(F.col(col) <= 0).select(F.col(col).alias("val"))


def check_not_empty(df: DataFrame) -> DataFrame:
    """One row with ``row_count = 0`` when ``df`` is empty (CHK-04, AGG-18)."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") == 0)


def report_violations(df: DataFrame, key: str, count: str) -> dict[str, int]:
    """Numbers of violating rows of the standing checks, from one aggregate."""
    k = F.col(key)
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col(count) <= 0, 1)).alias("low"))
    r = per_key.agg(F.count(F.when(k.isNotNull() & (F.col("n") > 1), 1)).alias("twice"), F.sum(F.when(k.isNull(), F.col("n"))).alias("none"),
                    F.sum("low").alias("low"), F.sum("n").alias("n")).first()
    return {f"unique_{key}": r.twice, f"not_null_{key}": r.none or 0, f"is_positive_{count}": r.low or 0,
            "not_empty_consent_company_day": 0 if r.n else 1}


class ObservedChecks:
    """Checks counted while a table is written, without a scan of their own.

    ``watch`` adds the counts to the plan of the rows on their way to the table;
    ``violations`` waits for the first action on them. ``whole`` says that these
    rows are the whole table, so that no row and a missing expected key are
    violations too. Uniqueness and duplicates of an expected key have no such
    form: ``report_violations`` and ``check_expected`` count them. A task that is
    run again for a lost executor may count a row twice, so a number above zero
    may be too high; a zero is exact."""

    def __init__(self, key: str, count: str, expected: list[tuple[dict, str, float]] | None = None, whole: bool = True):
        self.key, self.count, self.expected, self.whole = key, count, expected or [], whole
        self.observation = Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        n = lambda cond: F.count(F.when(cond, 1))
        counts = [F.count(F.lit(1)).alias("rows"), n(F.col(self.key).isNull()).alias("none"), n(F.col(self.count) <= 0).alias("low")]
        for i, (key, col, value) in enumerate(self.expected):
            here = F.lit(True)
            for k, v in key.items():
                here = here & F.col(k).eqNullSafe(F.lit(v))
            counts += [n(here).alias(f"found_{i}"),
                       n(here & ~F.col(col).cast("double").eqNullSafe(F.lit(value).cast("double"))).alias(f"wrong_{i}")]
        return df.observe(self.observation, *counts)

    def violations(self) -> dict[str, int]:
        m = self.observation.get
        out = {f"not_null_{self.key}": m["none"], f"is_positive_{self.count}": m["low"]}
        if self.whole:
            out["not_empty_consent_company_day"] = 0 if m["rows"] else 1
        for i in range(len(self.expected)):
            out[f"expected_{i}"] = 1 if m[f"wrong_{i}"] or (self.whole and not m[f"found_{i}"]) else 0
        return out


def check_expected(df: DataFrame, key: dict, col: str, expected) -> DataFrame:
    """Rows for ``key`` whose ``col`` differs from ``expected`` (CHK-05), plus
    one row when the key is missing or duplicated (the plain test passes
    vacuously on a missing row, trap D23)."""
    spark = df.sparkSession
    wanted = spark.range(1).select(*[F.lit(v).alias(k) for k, v in key.items()], F.lit(expected).cast("double").alias("expected"))
    return check_expected_values(df, wanted, list(key), col)


def check_expected_values(df: DataFrame, wanted: DataFrame, keys: list[str], col: str) -> DataFrame:
    """The same for a table of expected values: one join, one aggregate."""
    found = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.first(F.col(col)).cast("double").alias("actual"))
    j = wanted.join(found, keys, "left")
    problem = (F.when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "duplicate")
               .when(~F.col("actual").eqNullSafe(F.col("expected")), "mismatch"))
    return j.select(*keys, F.when(F.col("n") == 1, F.col("actual")).alias("actual"), problem.alias("problem")).where(
        F.col("problem").isNotNull())


def reconcile_raw_report(raw: DataFrame, report: DataFrame) -> DataFrame:
    """Company-days where the raw unrounded volume and the report's rounded
    event count differ by more than the rounding noise (CHK-07, trap D21:
    each event row contributes at most 0.5 of rounding)."""
    r = raw.groupBy(F.col("APIKEY").alias("company_id"), F.to_date("EVENT_TIME").alias("date_day")) \
        .agg(F.sum(F.col("COUNT") / F.col("RATE")).alias("raw_event_count"),
             F.count(F.lit(1)).alias("raw_rows"))
    rep = report.select("company_id", "date_day", "event_count")
    j = r.join(rep, ["company_id", "date_day"], "full")
    diff = F.abs(F.coalesce("raw_event_count", F.lit(0.0)) - F.coalesce("event_count", F.lit(0.0)))
    return j.where(F.col("event_count").isNull() | F.col("raw_event_count").isNull()
                   | (diff > 0.5 * F.col("raw_rows")))
