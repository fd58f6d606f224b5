"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from consentflow import queries as Q
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, digest

NAMES = sorted(Q.QUERIES)  # the training-data operators have their own tests


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    missing = set(NAMES) - set(E.oracle_sql())
    assert not missing, missing


def _arrow_types(rel):
    table = rel.to_arrow_table() if hasattr(rel, "to_arrow_table") else rel.arrow()
    return {f.name: str(f.type) for f in table.schema}


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    # same column types on both sides (row hashes are type-sensitive)
    s_types = {f.name: str(f.type) for f in df.toArrow().schema}
    assert s_types == _arrow_types(con.sql(E.oracle_sql()[name]))
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    o_cols, o_rows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(s_cols) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    hs, ls = digest(s_cols, s_rows)
    ho, lo = digest(o_cols, o_rows)
    assert hs == ho, (sorted(set(ls) - set(lo))[:3], sorted(set(lo) - set(ls))[:3])
    # the same through pandas (how some harnesses compare): str() of each value
    assert _pandas_rows(df.toPandas()) == _pandas_rows(con.sql(E.oracle_sql()[name]).df())


def _pandas_rows(pdf):
    cols = sorted(pdf.columns)
    return sorted("|".join("NULL" if v is None or (isinstance(v, float) and v != v) else str(v)
                           for v in r) for r in pdf[cols].itertuples(index=False, name=None))


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "consent_uq" in df.columns and "consent_conversion_rate" in df.columns


# The checks on intact data: they find nothing, and have a twin that does.
EMPTY = {"check_unique", "check_positive", "check_not_empty", "check_expected", "reconcile_raw_report", "unknown_countries_anti",
         "orphan_companies_anti", "duplicate_event_ids", "duplicate_consent_keys"}


def test_no_other_comparison_is_empty_with_empty(con):
    for name in set(NAMES) - EMPTY:
        assert con.execute(f"SELECT count(*) FROM ({E.oracle_sql()[name]}) AS q").fetchone()[0] > 0, name
