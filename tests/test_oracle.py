"""Every registered query against its SQL, row by row."""

import os
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from crisis_posts.plans import catalog, oracle

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(SF_DIR) / f"{name}.parquet"
        connection.execute(f"create view {name} as select * from '{path}'")
    yield connection
    connection.close()


def rows_by_name(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_every_query_has_sql():
    assert catalog.QUERIES.keys() == oracle.SQL.keys() <= queries().keys()
    assert oracle_sql().keys() <= queries().keys()


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    ours = queries()[name](spark, SF_DIR)
    relation = duck.sql(oracle_sql()[name])
    assert {name: SQL_TYPES[kind] for name, kind in ours.dtypes} == dict(
        zip(relation.columns, map(str, relation.types))
    )
    expected = rows_by_name(relation.columns, relation.fetchall())
    found = rows_by_name(ours.columns, [tuple(row) for row in ours.collect()])
    assert len(found) == len(expected) > 0
    wrong = [(a, b) for a, b in zip(found, expected) if a != b]
    assert not wrong, wrong[:3]


def test_entry(spark):
    table = entry(spark).collect()
    assert len(table) == 1 + 6 + 26
    assert {row.dimension for row in table} == {"overall", "aidr_label", "place_state"}
