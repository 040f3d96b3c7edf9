"""Queries that SQL can say, against another engine."""

import duckdb
import pytest

from rangemap.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, sf, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    found = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    df = queries.QUERIES[name](spark, sf)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(found.fetchall())


def test_every_operator_has_its_query():
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, 14))
