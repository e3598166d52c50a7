"""Every registered query against its SQL definition in another engine."""

import os

import duckdb
import pytest

from tidemark.plans.catalog import QUERIES
from tidemark.plans.oracle import ORACLE

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(sf_dir, name)}.parquet'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def show(value):
        return repr(round(value, 6) + 0.0) if isinstance(value, float) else str(value)

    return sorted(tuple(show(row[i]) for i in order) for row in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    assert sorted(df.columns) == sorted(columns)
    assert {f.name: KINDS[f.dataType.simpleString()] for f in df.schema.fields} == kinds
    assert canonical(df.collect(), df.columns) == canonical(cursor.fetchall(), columns)
