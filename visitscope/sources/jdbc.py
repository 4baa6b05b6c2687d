"""Task table and result tables over JDBC.

Spark's JDBC source opens its own connections per task, so there is no
connection pool here. Reads by key push the equality into the database's
WHERE clause; large reads are split into `num_partitions` range queries
on a numeric column; writes go out per partition in batches.

Nothing in the test suite opens a database: these functions build the
reader/writer and are exercised only up to the point of connecting.
"""

from __future__ import annotations

import datetime as dt
import decimal
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, DataFrameReader, DataFrameWriter, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str | None = None
    extra: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        opts = {"url": self.url, **self.extra}
        if self.user is not None:
            opts["user"] = self.user
        if self.password is not None:
            opts["password"] = self.password
        if self.driver is not None:
            opts["driver"] = self.driver
        return opts


def reader(spark: SparkSession, target: JdbcTarget) -> DataFrameReader:
    r = spark.read.format("jdbc")
    for key, value in target.options().items():
        r = r.option(key, value)
    return r


def read_table(spark: SparkSession, target: JdbcTarget, table: str, *,
               partition_column: str | None = None, lower_bound: int | None = None,
               upper_bound: int | None = None, num_partitions: int | None = None,
               fetch_size: int = 10_000) -> DataFrame:
    """A database table as a DataFrame, read in parallel when a split column is given.

    Name a numeric or date `partition_column` for any large table: without one
    the whole table comes through one connection. Bounds that are not given are
    asked of the database, one row.
    """
    r = reader(spark, target).option("dbtable", table).option("fetchsize", str(fetch_size))
    if partition_column is not None:
        if num_partitions is None:
            num_partitions = spark.sparkContext.defaultParallelism
        if lower_bound is None or upper_bound is None:
            bounds = read_query(spark, target, f"SELECT min({partition_column}) AS lo, max({partition_column}) AS hi FROM {table}").first()
            lower_bound = bounds["lo"] if lower_bound is None else lower_bound
            upper_bound = bounds["hi"] if upper_bound is None else upper_bound
        if lower_bound is None or upper_bound is None:  # no rows, or no keys
            return r.load()
        r = (r.option("partitionColumn", partition_column)
             .option("lowerBound", str(lower_bound))
             .option("upperBound", str(upper_bound))
             .option("numPartitions", str(num_partitions)))
    return r.load()


def literal(value) -> str:
    """A value as an SQL literal; text in quotes, quotes doubled."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float, decimal.Decimal)):
        return str(value)
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    return "'" + str(value).replace("'", "''") + "'"


def hash_predicates(column: str, parts: int, bucket_sql: Callable[[str, int], str] | None = None) -> list[str]:
    """One WHERE clause a part by a hash of `column`, for keys that are no numbers.

    `bucket_sql(column, parts)` is the database's expression for a number from
    0 to parts - 1, null for a null key; the default is MySQL's and MariaDB's
    CRC32. Every row is in exactly one part; nulls are in the first.
    """
    bucket = (bucket_sql or (lambda c, n: f"MOD(CRC32({c}), {n})"))(column, parts)
    return [f"{bucket} = {k}" + (f" OR {column} IS NULL" if k == 0 else "") for k in range(parts)]


def range_predicates(column: str, cuts: Sequence, hot: Callable[[str], list[str]] | None = None) -> list[str]:
    """WHERE clauses that cut `column` at the measured quantiles `cuts`.

    Every row is in exactly one clause; nulls are in the first. A value that
    stands more than once among the cuts fills a whole part by itself and gets
    a clause of its own, which `hot(clause)` may split further, by a hash of
    another column for instance.
    """
    ordered = sorted(c for c in cuts if c is not None)
    twice = {c for a, c in zip(ordered, ordered[1:], strict=False) if a == c}
    points = sorted(set(ordered))
    if not points:
        return ["1 = 1"]
    clauses, low = [], None
    for point in [*points, None]:
        parts = []
        if low is not None:
            parts.append(f"{column} {'>' if low in twice else '>='} {literal(low)}")
        if point is not None:
            parts.append(f"{column} < {literal(point)}")
        clause = " AND ".join(parts)
        clauses.append(f"{clause} OR {column} IS NULL" if low is None else clause)
        if point in twice:
            single = f"{column} = {literal(point)}"
            clauses += hot(single) if hot else [single]
        low = point
    return clauses


def measured_cuts(sample: DataFrame, column: str, parts: int, accuracy: int = 10_000) -> list:
    """The parts - 1 inner quantiles of a number, date or time `column` over `sample`, repeated where a value is hot.

    One aggregate with mergeable sketches. `sample` is what the database gives
    of the key column, by a sampling query where the table is large.
    """
    if dict(sample.dtypes)[column] == "string":
        raise ValueError(f"{column} is text; split it by hash_predicates")
    shares = ", ".join(str(k / parts) for k in range(1, parts))
    if parts < 2:
        return []
    found = sample.selectExpr(f"percentile_approx({column}, array({shares}), {accuracy}) AS cuts").first()["cuts"]
    return list(found or [])


def read_split(spark: SparkSession, target: JdbcTarget, table: str, predicates: Sequence[str], fetch_size: int = 10_000) -> DataFrame:
    """A database table read by one query for each of `predicates`.

    For keys that ranges of equal width would split unevenly: see
    `range_predicates` and `hash_predicates`.
    """
    if not predicates:
        raise ValueError("at least one predicate is needed")
    properties = {k: v for k, v in target.options().items() if k != "url"} | {"fetchsize": str(fetch_size)}
    return spark.read.jdbc(target.url, table, predicates=[f"({p})" for p in predicates], properties=properties)


def read_query(spark: SparkSession, target: JdbcTarget, query: str) -> DataFrame:
    """Rows of a SELECT run by the database (S6); one connection, so for small results."""
    return reader(spark, target).option("query", query).load()


def read_tasks(spark: SparkSession, target: JdbcTarget, table: str = "task", task_id: int | None = None) -> DataFrame:
    """The task table, or one task of it."""
    return task_rows(read_table(spark, target, table), task_id)


def task_rows(stored: DataFrame, task_id: int | None = None) -> DataFrame:
    """Stored tasks under the engine's types.

    The key is compared on the stored column, before any cast, so the equality
    reaches the database whatever number type the column has.
    """
    if task_id is not None:
        stored = stored.where(F.col("task_id") == F.lit(int(task_id)))
    return stored.select(
        F.col("task_id").cast("bigint").alias("task_id"),
        *[F.col(c).cast("string").alias(c) for c in (
            "task_name", "create_time", "start_time", "finish_time",
            "task_type", "task_status", "task_param")],
    )


def writer(df: DataFrame, target: JdbcTarget, table: str, *, mode: str = "append",
           batch_size: int = 1000, isolation_level: str = "READ_COMMITTED",
           num_partitions: int | None = None) -> DataFrameWriter:
    """Batched insert of a DataFrame (K1 one row per insert, K2 batches).

    Each partition commits on its own connection; pass `num_partitions=1`
    for one all-or-nothing transaction (only sensible for small results,
    such as the 16-row statistics). `num_partitions` also caps the number
    of concurrent connections to the database.
    """
    # A shuffle, so the stages above keep their own parallelism.
    out = df.repartition(num_partitions) if num_partitions else df
    w = out.write.format("jdbc").mode(mode)
    for key, value in target.options().items():
        w = w.option(key, value)
    return (w.option("dbtable", table)
            .option("batchsize", str(batch_size))
            .option("isolationLevel", isolation_level))


def write_table(df: DataFrame, target: JdbcTarget, table: str, **kwargs) -> None:
    writer(df, target, table, **kwargs).save()


EXISTS_QUERY = "SELECT count(*) AS n FROM information_schema.tables WHERE lower(table_name) = lower({name})"


def table_exists(spark: SparkSession, target: JdbcTarget, table: str, exists_query: str = EXISTS_QUERY) -> bool:
    """Whether the database has `table`, asked of its catalog; the default query is the SQL standard's."""
    name = literal(table.rsplit(".", 1)[-1].strip('"`[]'))
    return read_query(spark, target, exists_query.format(name=name)).first()["n"] > 0


def append_task_once(rows: DataFrame, target: JdbcTarget, table: str, task_id: int, exists_query: str = EXISTS_QUERY) -> bool:
    """Append a task's result rows in one transaction unless the table has them; whether it wrote.

    An absent table is created by the append. The rows go out as one partition,
    so a failed run leaves none of them and a repeated run finds all or nothing.
    The look-up and the append are two steps: of two runs of one task at the
    same time both may write. A unique key on (task_id, metric) in the database
    makes the second one fail as a whole; without it, run a task once at a time.
    """
    spark = rows.sparkSession
    if table_exists(spark, target, table, exists_query):
        stored = read_table(spark, target, table)
        if not stored.where(F.col("task_id") == F.lit(int(task_id))).limit(1).isEmpty():
            return False
    write_table(rows, target, table, num_partitions=1)
    return True
