"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    return None if isinstance(v, float) and math.isnan(v) else v


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def test_every_query_of_the_survey_has_an_oracle():
    """Queries without SQL are held against plain versions in tests/llm."""
    from voltframe.catalog import QUERIES
    assert set(QUERIES) <= set(SQL) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)
    res = con.execute(SQL[name])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == cols
    idx = {c: i for i, c in enumerate(ocols)}
    want = sorted((tuple(_norm(r[idx[c]]) for c in cols) for r in res.fetchall()), key=_key)
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:2] == ["state", "county"]
