"""Every query against its SQL on the same tables."""

import pytest
from compare import connect, duckdb_rows, kinds, spark_rows

import __spark_entry__ as driver
from workload.oracles import ORACLES
from workload.queries import QUERIES

TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "float": "FLOAT",
    "double": "DOUBLE",
    "timestamp": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    sql = ORACLES[name]
    expected = kinds(con, sql)
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == expected
    found = spark_rows(df)
    assert found
    assert found == duckdb_rows(con, sql)


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() > 0
