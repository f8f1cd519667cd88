"""Differential: every registered query against its DuckDB SQL (sf0.001)."""

import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, digest

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_oracle():
    from tanimart.plans import oracle_sql, queries
    assert set(oracle_sql.ORACLE) == set(queries.REGISTRY)
    assert set(E.oracle_sql()) <= set(E.queries())


#: Queries over the test tables must not be empty.
@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows) > 0
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["source_id", "target_id", "score", "rank", "tied_at_cutoff"]
    assert df.count() > 0
