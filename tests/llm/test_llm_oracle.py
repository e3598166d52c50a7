"""The training-data queries that SQL can say, against that SQL in another engine."""

import duckdb
import pytest

from tidemark.llm.catalog import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df, cursor = QUERIES[name](spark, SF), con.execute(ORACLE[name])
    columns = sorted(d[0] for d in cursor.description)
    assert sorted(df.columns) == columns
    place = [[d[0] for d in cursor.description].index(c) for c in columns]
    want = sorted(str([row[i] for i in place]) for row in cursor.fetchall())
    assert sorted(str([row[c] for c in columns]) for row in df.collect()) == want
