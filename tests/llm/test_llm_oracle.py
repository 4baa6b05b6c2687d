"""Queries that SQL can express, against their SQL in DuckDB."""

import duckdb
import pytest
from llm_helpers import by_value

from visitscope.llm.catalog import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    found = QUERIES[name](spark, SF)
    want = con.sql(ORACLE[name])
    columns = sorted(found.columns)
    assert columns == sorted(want.columns)
    rows = [tuple(r[c] for c in columns) for r in found.collect()]
    at = [want.columns.index(c) for c in columns]
    assert by_value(rows) == by_value([tuple(r[k] for k in at) for r in want.fetchall()])
    con.close()


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
