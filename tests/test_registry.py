import os

import duckdb
import pytest
from helpers import plan_of

from __spark_entry__ import entry
from compare_oracle import TABLES, normalized, odd_types
from duelmetrics.registry.oracles import ORACLES
from duelmetrics.registry.queries import QUERIES

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry(spark).count() == 7


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = normalized(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert not odd_types(df, cursor.description)
    assert got == normalized(columns, cursor.fetchall())
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "InPandas" not in plan
