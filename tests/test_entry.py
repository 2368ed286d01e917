"""Driver contract: entry smoke check and a sample of registered queries against DuckDB."""

import decimal
import os

import duckdb
import pytest

import __spark_entry__ as E
from strata.sources.testbed import TABLES

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "zone_month_id" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 60


def norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return str(v)
    return v


@pytest.mark.parametrize("name", ["fct_zone_revenue_monthly", "pii_tokens", "gate_verdict", "scd2_merge",
                                  "structural_tests", "column_profile", "kl_divergence"])
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    df = E.queries()[name](spark, SF)
    cur = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    want = sorted((tuple(norm(r[cols.index(c)]) for c in sorted(cols)) for r in cur.fetchall()), key=repr)
    got = sorted((tuple(norm(r[c]) for c in sorted(df.columns)) for r in df.collect()), key=repr)
    assert sorted(df.columns) == sorted(cols)
    assert got == want
