"""Every query on the smallest test tables against its SQL in DuckDB."""

import os

import duckdb
import pytest

from __spark_entry__ import entry
from wattline.plans import upkeep  # noqa: F401, registers queries
from wattline.plans.catalog import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(FOLDER):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{file}'")
    return connection


def text(rows):
    return sorted(tuple(repr(value) for value in row) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, FOLDER)
    columns = sorted(result.columns)
    selected = ", ".join(f'"{column}"' for column in columns)
    found = duck.execute(f"SELECT {selected} FROM ({SQL[name]})").fetchall()
    wide = duck.execute(f"SELECT * FROM ({SQL[name]}) LIMIT 0").description
    assert sorted(column[0] for column in wide) == columns
    assert text(result.select(*[f"`{column}`" for column in columns]).collect()) == text(found)


def test_entry(spark):
    assert entry(spark).count() > 0
