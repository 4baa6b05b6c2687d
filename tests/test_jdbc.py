"""JDBC helpers without a database: option building and argument checks."""

from __future__ import annotations

import pytest

from visitscope.sources import jdbc
from pyspark.sql import DataFrameReader

from visitscope.sources.jdbc import (
    JdbcTarget,
    append_task_once,
    hash_predicates,
    measured_cuts,
    range_predicates,
    read_split,
    read_table,
    task_rows,
    writer,
)


def test_target_options():
    t = JdbcTarget("jdbc:x://h/db", user="u", password="p", driver="d", extra={"fetchsize": "5"})
    assert t.options() == {"url": "jdbc:x://h/db", "user": "u", "password": "p", "driver": "d",
                           "fetchsize": "5"}


class Reader:
    """Stands for a JDBC reader; nothing is opened."""

    def __init__(self):
        self.options = {}

    def option(self, key, value):
        self.options[key] = value
        return self

    def load(self):
        return self.options


class Row(dict):
    def first(self):
        return self


def test_parallel_read_asks_for_missing_bounds(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(jdbc, "reader", lambda spark, target: Reader())
    monkeypatch.setattr(jdbc, "read_query", lambda s, t, q: (asked.append(q), Row(lo=3, hi=90))[1])
    opts = read_table(spark, JdbcTarget("jdbc:x://h/db"), "t", partition_column="id")
    assert opts["lowerBound"] == "3" and opts["upperBound"] == "90" and int(opts["numPartitions"]) >= 1
    assert asked == ["SELECT min(id) AS lo, max(id) AS hi FROM t"]
    opts = read_table(spark, JdbcTarget("jdbc:x://h/db"), "t", partition_column="id", lower_bound=0, upper_bound=9, num_partitions=4)
    assert opts["numPartitions"] == "4" and len(asked) == 1
    monkeypatch.setattr(jdbc, "read_query", lambda s, t, q: Row(lo=None, hi=None))
    assert "partitionColumn" not in read_table(spark, JdbcTarget("jdbc:x://h/db"), "t", partition_column="id")


def test_password_stays_out_of_repr():
    assert "secret" not in repr(JdbcTarget("jdbc:x://h/db", user="u", password="secret"))


@pytest.mark.parametrize("kind", ["int", "bigint", "decimal(20,0)"])
def test_task_key_is_compared_before_the_cast(spark, tmp_path, kind):
    names = ["task_name", "create_time", "start_time", "finish_time", "task_type", "task_status", "task_param"]
    stored = spark.range(5).selectExpr(f"cast(id AS {kind}) AS task_id", *(f"'x' AS {n}" for n in names))
    stored.write.parquet(str(tmp_path / "task"))
    found = task_rows(spark.read.parquet(str(tmp_path / "task")), 3)
    assert [r.task_id for r in found.collect()] == [3] and dict(found.dtypes)["task_id"] == "bigint"
    assert "EqualTo(task_id,3)" in found._jdf.queryExecution().executedPlan().toString()


def test_result_rows_are_appended_once(spark, monkeypatch):
    rows = spark.createDataFrame([("a", 1, 7)], "metric string, cnt long, task_id long")
    table, written = {"rows": rows.limit(0)}, []
    monkeypatch.setattr(jdbc, "table_exists", lambda s, t, name, query: bool(written))
    monkeypatch.setattr(jdbc, "read_table", lambda s, t, name: table["rows"])
    monkeypatch.setattr(jdbc, "write_table", lambda df, t, name, **kw: (written.append(kw), table.update(rows=df)))
    target = JdbcTarget("jdbc:x://h/db")
    assert append_task_once(rows, target, "stats", 7) is True
    assert append_task_once(rows, target, "stats", 7) is False
    assert written == [{"num_partitions": 1}]


def test_writer_shuffles_into_its_partitions(spark):
    frames = []
    original = type(spark.range(1)).write
    assert original is not None
    df = spark.range(0, 100, 1, 8)
    w = writer(df, JdbcTarget("jdbc:x://h/db"), "t", num_partitions=3)
    frames.append(w._df)
    plan = frames[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition 3, true" in plan


def test_writer_is_lazy(spark):
    df = spark.range(3)
    w = writer(df, JdbcTarget("jdbc:x://h/db"), "t", num_partitions=1)
    assert w is not None  # nothing is written until save()


def test_absent_table_is_created_by_the_append(spark, monkeypatch):
    rows = spark.createDataFrame([("a", 1, 7)], "metric string, cnt long, task_id long")
    asked, written = [], []
    monkeypatch.setattr(jdbc, "read_query", lambda s, t, q: (asked.append(q), Row(n=0))[1])
    monkeypatch.setattr(jdbc, "read_table", lambda *a: pytest.fail("an absent table is not read"))
    monkeypatch.setattr(jdbc, "write_table", lambda df, t, name, **kw: written.append(name))
    assert append_task_once(rows, JdbcTarget("jdbc:x://h/db"), "analytics.stat's", 7)
    assert written == ["analytics.stat's"] and "lower('stat''s')" in asked[0]


def held_by(spark, df, predicates):
    """How many of the clauses hold for each row."""
    df.createOrReplaceTempView("split_rows")
    return spark.sql("SELECT k, " + " + ".join(f"CASE WHEN {p} THEN 1 ELSE 0 END" for p in predicates) + " AS n FROM split_rows").collect()


def test_range_predicates_hold_each_row_once_and_split_hot_keys(spark):
    df = spark.range(4000).selectExpr("CASE WHEN id % 50 = 0 THEN NULL WHEN id % 3 = 0 THEN 7 ELSE id END AS k")
    cuts = measured_cuts(df, "k", 12)
    assert len(cuts) == 11 and cuts.count(7) >= 3
    split = range_predicates("k", cuts, hot=lambda clause: [f"{clause} AND 1 = 1"])
    assert "k = 7 AND 1 = 1" in split
    assert all(r.n == 1 for r in held_by(spark, df, split))
    sizes = [df.where(p).count() for p in split if not p.startswith("k = 7")]
    assert max(sizes) <= 4000 / 12 * 1.6
    assert range_predicates("k", []) == ["1 = 1"] and measured_cuts(df, "k", 1) == []


@pytest.mark.parametrize("kind", ["date", "timestamp_ntz", "decimal(12,2)", "double"])
def test_range_predicates_of_other_types(spark, kind):
    at = "date_add(date'2024-01-01', cast(id as int))"
    value = at if kind == "date" else f"CAST(CAST({at} AS TIMESTAMP) AS timestamp_ntz)" if kind == "timestamp_ntz" else f"CAST(id / 7 AS {kind})"
    df = spark.range(300).selectExpr(f"{value} AS k").unionAll(spark.range(3).selectExpr(f"CAST(NULL AS {kind}) AS k"))
    split = range_predicates("k", measured_cuts(df, "k", 5))
    assert len(split) == 5 and all(r.n == 1 for r in held_by(spark, df, split))


def test_hash_predicates_hold_each_row_once(spark):
    df = spark.createDataFrame([(k,) for k in ["a", "b", "it's", "", None, "ü"] * 20], "k string")
    split = hash_predicates("k", 4, lambda c, n: f"pmod(hash({c}), {n})")
    assert all(r.n == 1 for r in held_by(spark, df.where("k IS NOT NULL"), split))
    assert split[0].endswith("OR k IS NULL") and hash_predicates("k", 2)[1] == "MOD(CRC32(k), 2) = 1"
    with pytest.raises(ValueError):
        measured_cuts(df, "k", 3)


def test_split_read_passes_its_predicates(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(DataFrameReader, "jdbc", lambda self, url, table, **kw: seen.update(kw, url=url, table=table) or "frame")
    got = read_split(spark, JdbcTarget("jdbc:x://h/db", user="u"), "t", ["a < 1 OR a IS NULL", "a >= 1"])
    assert got == "frame" and seen["predicates"] == ["(a < 1 OR a IS NULL)", "(a >= 1)"]
    assert seen["properties"] == {"user": "u", "fetchsize": "10000"} and seen["url"] == "jdbc:x://h/db"
    with pytest.raises(ValueError):
        read_split(spark, JdbcTarget("jdbc:x://h/db"), "t", [])
