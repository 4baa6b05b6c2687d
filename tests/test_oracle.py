"""Every registered query against its SQL in DuckDB (the driver's gate, run at sf0.001)."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001
from visitscope.plans.catalog import QUERIES
from visitscope.plans.oracle import ORACLE

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    yield con
    con.close()


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, bool):
            return int(v)
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, 9)
        return v

    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _canon(rows, df.columns) == _canon(rel.fetchall(), rel.columns)


def test_entry_smoke(spark):
    out = E.entry(spark)
    rows = out.collect()
    assert out.columns == ["metric", "cnt"] and len(rows) == 16
    # FIXTURES.md section 2: 713 sessions in the whole sf0.001 events table
    assert dict((r.metric, r.cnt) for r in rows)["session_count"] == 713
