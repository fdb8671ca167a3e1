"""Every registered query against its reference SQL on DuckDB (sf0.001)."""

import os

import pytest

import __spark_entry__ as E
from farelane.plans import registry
from tools.check_oracle import TABLES, digest

from tests.conftest import SF_SMALL

KEYS = sorted(registry.queries())


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_reference_sql():
    assert set(registry.oracle_sql()) == set(registry.queries())
    assert set(registry.queries()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "revenue_zone" in df.columns


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_reference_sql(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len({c.lower() for c in df.columns}) == len(df.columns)  # else the result cannot be stored
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]
