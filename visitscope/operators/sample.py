"""One sample row of a table (L1).

The row is the first by one stored key, ties by all columns, so repeated
runs return the same row. The key's least value is a scalar subquery over that
one column; the rows that have it are fetched by an equality, which reaches the
scan with the subquery's value. All of it is one query, run when it is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def least_rows(df: DataFrame, key: str) -> DataFrame:
    """The rows of `df` whose `key` is least; those without a key where no row has one."""
    least = df.agg(F.min(key)).scalar()
    return df.where(F.col(key).eqNullSafe(least))


def sample_row(df: DataFrame, key: str | None = None) -> DataFrame:
    """The first row of `df` by `key` (by the columns' order without one), ties by all columns."""
    rows = least_rows(df, key) if key else df
    return rows.orderBy(*(F.col(c).asc_nulls_first() for c in rows.columns)).limit(1)
