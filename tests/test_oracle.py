"""Every query of the workload against its SQL in DuckDB."""

import duckdb
import pytest

import __spark_entry__ as registered
from asthen_workload import catalog, oracle
from asthen_workload.bindings import TEST_TABLES

SF = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE",
         "timestamp_ntz": "TIMESTAMP"}
QUERIES, ORACLE = catalog.all_queries(), oracle.all_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TEST_TABLES:
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(registered.queries()) and set(ORACLE) <= set(registered.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    described = {r[0]: r[1] for r in duck.execute("describe " + ORACLE[name]).fetchall()}
    assert {c: TYPES[t] for c, t in df.dtypes} == described
    columns = sorted(described)
    expected = duck.execute(f"select {', '.join(columns)} from ({ORACLE[name]})").fetchall()
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert len(got) > 0
    assert sorted(map(str, got)) == sorted(map(str, expected))


def test_entry(spark):
    assert registered.entry(spark).count() == 150
