"""Every registered query against its independent DuckDB SQL (row count,
column names and an order-insensitive value hash), on sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from lodgespark import catalog as CAT
from tests.conftest import SF_SMALL
from tools.check_oracle import TABLES, digest, type_mismatches

QUERIES = CAT.registry()  # the optional parts have tests of their own
SQLS = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    sdf = QUERIES[key](spark, SF_SMALL)
    cols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    assert len(cols) == len(set(cols))
    if key not in SQLS:
        return
    cur = con.execute(SQLS[key])
    dcols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(dcols)
    drows = [tuple(r[dcols.index(c)] for c in cols) for r in cur.fetchall()]
    assert type_mismatches(sdf, con, SQLS[key]) == []
    assert len(srows) == len(drows)
    assert digest(srows, cols)[0] == digest(drows, cols)[0]


def test_every_query_has_an_oracle():
    assert set(QUERIES) - set(SQLS) == set()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["price_category", "count"]
