"""Every registered query equals its SQL oracle (DuckDB) on the small tables."""

import duckdb
import pytest

from conftest import SF_SMALL

import __spark_entry__ as E
from tools.oracle_check import TABLES, _hash, _norm

from qtrbars.plans.oracle import ORACLES as OWN_SQL
from qtrbars.plans.queries import QUERIES as OWN

# what other subpackages register is tested with them
QUERIES = {name: fn for name, fn in E.queries().items() if name in OWN}
ORACLES = {name: sql for name, sql in E.oracle_sql().items() if name in OWN_SQL}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = con.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _hash(_norm(got)) == _hash(_norm(want))


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "compound_return" in df.columns
