"""Every registered query against its DuckDB oracle on the smallest tables."""
import duckdb
import pytest

import __spark_entry__ as E
from cargoframe.sources.tables import TABLES
from tools.oracle_check import _rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    rel = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, srows) == _rows(dcols, rel.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "n_shipments" in df.columns
