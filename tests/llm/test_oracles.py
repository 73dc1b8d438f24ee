"""Every query with DuckDB SQL against that SQL on the smallest tables."""
import math

import duckdb
import pytest

from tests.conftest import SF001

TABLES = "documents pages benchmark labels conversations".split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _names():
    from campaign_engine.llm.queries import ORACLE
    return sorted(ORACLE)


@pytest.mark.parametrize("name", _names())
def test_query_equals_sql(spark, name):
    from campaign_engine.llm.queries import ORACLE, QUERIES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    df = QUERIES[name](spark, SF001)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=str)
    cur = con.execute(ORACLE[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = sorted((tuple(_norm(dict(zip(names, r))[c]) for c in cols) for r in cur.fetchall()), key=str)
    assert got == want
