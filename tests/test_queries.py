"""Each query of the registry against its SQL, in DuckDB, on the same tables."""

import duckdb
import pytest

from tallyloom.plans import registry

SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    for t in ("lineitem", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query_equals_its_sql(spark, sf, con, name):
    got = registry.queries()[name](spark, sf)
    columns = sorted(got.columns)
    rows = sorted(map(tuple, got.select(*columns).collect()), key=str)
    want = sorted(con.execute(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall(), key=str)
    assert len(rows) == len(want) and rows == want
    assert rows
