"""Every query against its SQL, on whole tables."""

import os

import duckdb
import pytest

from checks.oracles import ORACLES
from checks.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = ["orders", "customer"]


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')"
        )
    yield connection
    connection.close()


def rows_by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    ours = QUERIES[name](spark, SF_DIR)
    theirs = db.execute(ORACLES[name])
    names = [column[0] for column in theirs.description]
    assert sorted(ours.columns) == sorted(names)
    expected = rows_by_name(names, theirs.fetchall())
    assert expected
    assert rows_by_name(ours.columns, ours.collect()) == expected
