import os

import duckdb
import pytest

from consentflow.llm import queries as Q
from tools.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = Q.QUERIES[name](spark, SF)
    cur = con.execute(Q.ORACLE_SQL[name])
    cols, rows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(cols) == sorted(df.columns)
    types = {f.name: str(f.type) for f in df.toArrow().schema}
    assert types == {f.name: str(f.type) for f in con.sql(Q.ORACLE_SQL[name]).to_arrow_table().schema}
    mine, theirs = digest(df.columns, [tuple(r) for r in df.collect()]), digest(cols, rows)
    assert mine[0] == theirs[0], (sorted(set(mine[1]) - set(theirs[1]))[:3], sorted(set(theirs[1]) - set(mine[1]))[:3])
