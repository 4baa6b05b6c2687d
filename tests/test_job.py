"""Job-level behaviour: catalog source, join strategies, materialization, CLI."""

from __future__ import annotations

import contextlib
import io

import pytest

from conftest import SF001
from helpers import DAY, action, at, source, stats_dict, user
from visitscope.cli import main as cli_main
from visitscope.operators.filters import FilterSpec
from visitscope.operators.rollup import session_records_text
from visitscope.plans.job import materialize, session_stat_slots, session_stats
from visitscope.sources.tables import CatalogSource, register_views
from visitscope.sources.testdata import GeneratedSource

LO, HI = "2024-01-05", "2024-01-11"


def _fixture_rows():
    rows, users = [], []
    for i in range(40):
        rows += [action(f"s{i}", i % 6, at(j * 7 * (i % 5 + 1)), keyword=f"k{j % 4}", category=j % 9)
                 for j in range(i % 11 + 1)]
    users = [user(i, age=15 + 7 * i, sex="male" if i % 2 else "female") for i in range(6)]
    return rows, users


def test_catalog_source_equals_frame_source(spark):
    rows, users = _fixture_rows()
    frame = source(spark, rows, users)
    register_views(spark, frame.action_rows, frame.user_rows)
    catalog = CatalogSource(spark)
    spec = FilterSpec.of(start_age=20, end_age=40, keywords="k1")
    assert stats_dict(session_stats(catalog, DAY, DAY, spec)) == \
        stats_dict(session_stats(frame, DAY, DAY, spec))


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@contextlib.contextmanager
def _no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_sort_merge_join_when_broadcast_not_allowed(spark):
    src = GeneratedSource(spark, SF001)
    spec = FilterSpec.of(sex="male")
    expected = session_stat_slots(src, LO, HI, spec).collect()
    with _no_broadcast(spark):
        df = session_stat_slots(src, LO, HI, spec)
        got = df.collect()
        plan = _plan(df)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    final = plan.split("== Initial Plan ==")[0]
    # counts side arrives partitioned by user id: one exchange by user id per side, no more
    assert final.count("Exchange hashpartitioning(user_id") == 2
    assert final.count("Exchange hashpartitioning(session_id") == 1
    assert got == expected


def test_materialize_persist_and_checkpoint(spark):
    actions = GeneratedSource(spark, SF001).actions(LO, HI)
    base = sorted(session_records_text(actions).collect())
    for how in ("persist", "checkpoint"):
        kept = materialize(session_records_text(actions), how)
        assert sorted(kept.collect()) == base
        if how == "persist":
            kept.unpersist()
    with pytest.raises(ValueError):
        materialize(actions, "bogus")


def test_cli_runs_task_on_generated_tables(spark, capsys):
    cli_main(["--task-id", "42", "--sf-dir", SF001])
    out = capsys.readouterr().out.strip().splitlines()
    assert len(out) == 16 and out[0].startswith("session_count\t")


def test_cli_requires_task_id():
    with pytest.raises(SystemExit):
        cli_main(["--sf-dir", SF001])


def test_date_partitioned_table_is_pruned(spark, tmp_path):
    rows = [action(f"s{d}", 1, f"2018-04-{d:02d} 10:00:00", date=f"2018-04-{d:02d}") for d in range(5, 15)]
    frame = source(spark, rows, [user(1)])
    path = str(tmp_path / "user_visit_action")
    frame.action_rows.write.partitionBy("date").parquet(path)
    spark.read.parquet(path).createOrReplaceTempView("uva_partitioned")
    frame.user_rows.createOrReplaceTempView("user_info_partitioned")
    catalog = CatalogSource(spark, "uva_partitioned", "user_info_partitioned")
    df = catalog.actions("2018-04-09", "2018-04-10")
    plan = _plan(df)
    assert "PartitionFilters: [isnotnull(date" in plan and "2018-04-09" in plan
    got = stats_dict(session_stats(catalog, "2018-04-09", "2018-04-10"))
    assert got["session_count"] == 2


@contextlib.contextmanager
def _conf(spark, values: dict[str, str]):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_user_is_split_by_skew_join(spark):
    from pyspark.sql import functions as F

    from visitscope.operators.profile import attach_profile

    src = GeneratedSource(spark, SF001)
    # nine users in ten folded onto one owner: one user holds most sessions
    acts = src.actions().withColumn(
        "user_id", F.when(F.col("user_id") % 10 != 0, F.lit(5)).otherwise(F.col("user_id")))
    expected = sorted(attach_profile(session_records_text(acts), src.users()).collect())
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    with _conf(spark, settings):
        df = attach_profile(session_records_text(acts), src.users())
        got = sorted(df.collect())
        plan = _plan(df)
    assert "SortMergeJoin(skew=true)" in plan
    assert got == expected


def test_window_does_not_depend_on_process_time_zone(spark):
    import os
    import time

    import duckdb

    want = duckdb.sql(
        f"SELECT count(*) FROM read_parquet('{SF001}/events.parquet') "
        "WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12'").fetchall()[0][0]
    old = os.environ.get("TZ")
    try:
        os.environ["TZ"] = "Asia/Kolkata"
        time.tzset()
        got = GeneratedSource(spark, SF001).actions(LO, HI).count()
    finally:
        if old is None:
            os.environ.pop("TZ", None)
        else:
            os.environ["TZ"] = old
        time.tzset()
    assert got == want


def test_catalog_source_with_text_dates_and_times(spark):
    rows = [action("a", 1, "2018-04-09 7:05:09"), action("a", 1, "2018-04-09 17:05:09"),
            action("b", 1, "2018-04-10 0:00:00", date="2018-04-10"),
            action("c", 1, "2018-04-11 0:00:00", date="2018-04-11")]
    frame = source(spark, rows, [user(1)])
    frame.action_rows.createOrReplaceTempView("uva_text")
    frame.user_rows.createOrReplaceTempView("user_info_text")
    catalog = CatalogSource(spark, "uva_text", "user_info_text")
    assert dict(catalog.actions("2018-04-09", "2018-04-10").dtypes)["action_time"].startswith("timestamp")
    got = stats_dict(session_stats(catalog, "2018-04-09", "2018-04-10"))
    assert got["session_count"] == 2 and got["30m"] == 1


def test_session_bucketed_table_needs_no_session_shuffle(spark, tmp_path):
    from visitscope.operators.rollup import session_core

    rows, users = _fixture_rows()
    frame = source(spark, rows, users)
    (frame.action_rows.write.bucketBy(8, "session_id").sortBy("session_id")
     .option("path", str(tmp_path / "uva_bucketed")).mode("overwrite").saveAsTable("uva_bucketed"))
    frame.user_rows.createOrReplaceTempView("user_info_b")
    try:
        catalog = CatalogSource(spark, "uva_bucketed", "user_info_b")
        df = session_core(catalog.actions(DAY, DAY))
        plan = _plan(df)
        assert "Exchange hashpartitioning(session_id" not in plan
        assert "Bucketed: true" in plan
        assert stats_dict(session_stats(catalog, DAY, DAY)) == stats_dict(session_stats(frame, DAY, DAY))
    finally:
        spark.sql("DROP TABLE IF EXISTS uva_bucketed")


def test_fraction_in_time_text_keeps_the_visit_band(spark):
    for end in ("", ".0", ".123", " x"):
        rows = [action("s", 1, f"2018-04-09 7:05:{sec:02d}{end}") for sec in (9, 29)]
        stats = stats_dict(session_stats(source(spark, rows, [user(1)]), DAY, DAY))
        assert stats["10s_30s"] == 1 and stats["session_count"] == 1, end


def test_unparsed_times_are_counted(spark):
    from visitscope.sources.tables import unparsed_times

    rows = [action("s", 1, t) for t in ("2018-04-09 7:05:09.5", "2018-02-30 7:05:09", "soon", None)]
    found = unparsed_times(source(spark, rows, [user(1)]).action_rows).first()
    assert tuple(found) == (4, 2)


def test_list_rollup_sends_values_not_pairs(spark):
    from visitscope.operators.rollup import session_records, session_values

    rows = [action("s", 1, at(i), keyword=f"k{i % 200}", category=(i * 7 + i // 200) % 200) for i in range(2000)]
    rows += [action("s", 1, at(3000)), action("s", 1, at(3001), keyword="k0"), action("t", 2, at(0), keyword="")]
    actions = source(spark, rows, [user(1)]).actions(DAY, DAY)
    counts = {r["session_id"]: r["count"] for r in session_values(actions).groupBy("session_id").count().collect()}
    assert counts == {"s": 401, "t": 1}
    assert session_values(actions, categories=False).where("session_id = 's'").count() == 201
    record = {r.session_id: r for r in session_records(actions).collect()}
    assert record["s"].step_length == 2002 and len(record["s"].search_keywords) == 200 and len(record["s"].click_category_ids) == 200
    assert record["s"].visit_length == 3001 and record["t"].search_keywords == [] and record["t"].step_length == 1


def test_every_day_counts_without_a_range(spark):
    rows = [action("s", 1, at(0)), action("old", 1, "1999-12-31 7:00:00", date="1999-12-31"),
            action("new", 1, "2031-02-01 7:00:00", date="2031-02-01")]
    src = source(spark, rows, [user(1)])
    assert stats_dict(session_stats(src))["session_count"] == 3
    assert stats_dict(session_stats(src, DAY, DAY))["session_count"] == 1


@pytest.mark.parametrize("start,end", [("2018-04-10", "2018-04-09"), ("2018-04-09", None), (None, "2018-04-09"), ("x", "2018-04-09")])
def test_every_source_checks_the_range_alike(spark, start, end):
    rows = [action("s", 1, at(0))]
    frame = source(spark, rows, [user(1)])
    register_views(spark, frame.action_rows, frame.user_rows)
    for src in (frame, CatalogSource(spark), GeneratedSource(spark, SF001)):
        with pytest.raises(ValueError):
            src.actions(start, end)


def test_rewritten_folder_is_read_anew(spark, tmp_path):
    from visitscope.sources.testdata import read_table

    for extra in ([], ["'more' AS added"]):
        spark.range(len(extra) + 1).selectExpr(
            "id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' AS ts", "id AS user_id", "'click' AS event_type",
            "'{}' AS props", *extra).write.mode("overwrite").parquet(f"{tmp_path}/events.parquet")
        assert read_table(spark, str(tmp_path), "events").count() == len(extra) + 1


def test_stated_schemas_are_those_of_the_files(spark):
    from visitscope.sources.testdata import SCHEMAS, read_table

    for name in SCHEMAS:
        stored = dict(spark.read.parquet(f"{SF001}/{name}.parquet").dtypes)
        stated = dict(read_table(spark, SF001, name).dtypes)
        assert stated == {c: stored[c] for c in stated}, name


def test_checkpoint_runs_the_plan_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        for row in rows:
            seen.add(1)
            yield row

    df = spark.range(50).repartition(3).mapInPandas(lambda frames: (f for f in frames if seen.add(len(f)) is None), "id long")
    assert materialize(df, "checkpoint").count() == 50
    assert seen.value == 50


def test_cli_runs_the_job_once(spark, tmp_path, monkeypatch):
    import visitscope.cli as cli

    runs, real = [], cli.analyze_task

    def analysed(*args):
        df = real(*args)
        monkeypatch.setattr(type(df), "collect", lambda self, own=type(df).collect: (runs.append(self), own(self))[1])
        return df

    monkeypatch.setattr(cli, "analyze_task", analysed)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        cli_main(["--task-id", "12", "--sf-dir", SF001, "--output", str(tmp_path / "stats")])
    written = spark.read.parquet(str(tmp_path / "stats"))
    assert len(runs) == 1
    monkeypatch.undo()
    # What is written is the collected rows, not the plan over the events.
    assert {r.task_id for r in written.collect()} == {12}
    assert sorted(map(tuple, written.drop("task_id").collect())) == sorted(
        (line.split("\t")[0], int(line.split("\t")[1])) for line in out.getvalue().splitlines() if "\t" in line)


def test_category_ids_are_numbers(spark):
    from visitscope.operators.filters import category_hit

    hit = category_hit(FilterSpec.of(category_ids="7,007,x,8,99999999999999999999"))
    df = spark.createDataFrame([(7,), (8,), (9,), (None,)], "click_category_id long").select(hit.alias("h"))
    assert [r.h for r in df.collect()] == [True, True, False, None]
    assert "cast(click_category_id" not in df._jdf.queryExecution().optimizedPlan().toString().lower()
    nothing = spark.range(1).selectExpr("7L AS click_category_id").select(category_hit(FilterSpec.of(category_ids="x")).alias("h"))
    assert nothing.first().h is False


def test_all_six_filters_bite(spark):
    from conftest import SF01
    from visitscope.plans.catalog import ALL_SIX
    from visitscope.plans.job import filtered_sessions

    src = GeneratedSource(spark, SF01)
    every = filtered_sessions(src, spec=FilterSpec.of(**ALL_SIX)).count()
    assert every > 0
    for left_out in ({"start_age", "end_age"}, {"professionals"}, {"cities"}, {"sex"}, {"keywords"}, {"category_ids"}):
        spec = FilterSpec.of(**{k: v for k, v in ALL_SIX.items() if k not in left_out})
        assert filtered_sessions(src, spec=spec).count() > every, left_out


def test_match_report_drops_sessions(spark):
    from visitscope.plans.catalog import session_user_join_unmatched

    report = session_user_join_unmatched(spark, SF001).first()
    assert report.dropped > 0 and report.matched > 0 and report.sessions == report.matched + report.dropped


def test_session_choice(spark, monkeypatch):
    from pyspark.sql import SparkSession
    from visitscope.sources.tables import session

    hive = []
    monkeypatch.setattr(SparkSession.Builder, "enableHiveSupport", lambda self: (hive.append(1), self)[1])
    assert session() is spark and not hive
    assert session(hive=True) is spark and hive
