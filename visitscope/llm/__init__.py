"""Operations of a training-data pipeline, one module per operator.

Nothing outside this package imports it. `catalog.QUERIES` holds the
registered queries and `catalog.ORACLE` their DuckDB SQL.
"""
