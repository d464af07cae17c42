"""Every registered query against its SQL, over the smallest tables."""

import glob
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as contract
from catalog.queries import QUERIES
from conftest import SMALL


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return float(value) if isinstance(value, (int, float)) or type(value).__name__ == "Decimal" else value


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([plain(row[i]) for i in order]) for row in rows)


def test_every_query_has_sql():
    assert QUERIES.keys() <= contract.oracle_sql().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, database, name):
    result = contract.queries()[name](spark, SMALL)
    relation = database.sql(contract.oracle_sql()[name])
    assert sorted(result.columns) == sorted(relation.columns)
    ours = comparable(result.columns, result.collect())
    assert ours == comparable(relation.columns, relation.fetchall())
    assert ours


def test_core_queries_stay_without_an_optional_package():
    """A process in which a package that only the training-data operators need is missing."""
    program = (
        "import sys; sys.modules['xxhash'] = None; sys.modules['ahocorasick'] = None\n"
        "import __spark_entry__ as c\n"
        "from catalog.queries import QUERIES\n"
        "assert set(QUERIES) <= set(c.queries()) and set(c.oracle_sql()) <= set(c.queries())\n"
        "assert not any(name.startswith('op') for name in c.queries())\n"
    )
    folder = os.path.dirname(contract.__file__)
    subprocess.run([sys.executable, "-c", program], cwd=folder, check=True, timeout=120)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
