"""Registered queries against their SQL, over the smallest tables."""

import glob
import os

import duckdb
import pytest

from quotelane.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_its_sql(spark, name):
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        table = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    result, relation = QUERIES[name](spark, FOLDER), connection.sql(ORACLE[name])
    columns = sorted(result.columns)
    assert columns == sorted(relation.columns)
    ours = sorted(map(tuple, result.select(*columns).collect()))
    assert ours == sorted(relation.select(", ".join(columns)).fetchall()) and ours
