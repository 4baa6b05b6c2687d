"""Stored tables, results, the shared report, and what the reference declares without code."""

from __future__ import annotations

import itertools
import random
import re

import pytest

from conftest import SF001
from helpers import action, at, source, stats_dict, user
from test_plans import formatted
from visitscope.cli import main as cli_main
from visitscope.constants import stat_metrics
from visitscope.functions.packed import increment
from visitscope.operators.category import category_counts
from visitscope.operators.detail import detail_rows
from visitscope.operators.filters import FilterSpec
from visitscope.operators.flow import page_conversion, parse_flow, slice_states
from visitscope.operators.product import product_clicks
from visitscope.operators.stats import merge_packed
from visitscope.plans import catalog
from visitscope.plans.job import session_report, session_stats, session_stats_packed
from visitscope.sources.results import read_task_results, write_task_result
from visitscope.sources.stored import store_actions, stored_source
from visitscope.sources.testdata import GeneratedSource

METRICS = stat_metrics()


# ---------------- packed states ----------------

def state(**counts):
    return "|".join(f"{m}={counts.get(m, 0)}" for m in METRICS)


def merged(spark, rows, by=(), partitions=3):
    df = spark.createDataFrame(rows, "city string, stat string").repartition(partitions)
    return {tuple(r[c] for c in by): r["stat"] for r in merge_packed(df, by=list(by)).collect()}


def test_merge_adds_field_by_field_in_declared_order(spark):
    rows = [("a", state(session_count=2, **{"1s_3s": 1})), ("b", "60=4|session_count=5"), ("a", None), ("b", ""),
            ("a", "session_count=x|unknown=9|1_3=2=3"), ("b", "session_count=1|session_count=70|nothing")]
    assert merged(spark, rows) == {(): state(session_count=8, **{"1s_3s": 1, "60": 4})}
    assert merged(spark, rows, ["city"]) == {("a",): state(session_count=2, **{"1s_3s": 1}), ("b",): state(session_count=6, **{"60": 4})}


def test_merge_of_nothing_is_the_zero_state(spark):
    assert merged(spark, []) == {(): state()} and merged(spark, [], ["city"]) == {}


@pytest.mark.parametrize("partitions", [1, 4, 40])
def test_merge_does_not_depend_on_partitions(spark, partitions):
    rnd = random.Random(7)
    states = [{m: rnd.randint(0, 10**12) for m in METRICS} for _ in range(60)]
    total = state(**{m: sum(s[m] for s in states) for m in METRICS})
    assert merged(spark, [("a", state(**s)) for s in states], partitions=partitions) == {(): total}


def test_users_merge_to_the_whole(spark):
    whole = session_stats_packed(GeneratedSource(spark, SF001)).first()["stat"]
    assert catalog.packed_merge(spark, SF001).first()["stat"] == whole
    text = formatted(catalog.packed_merge(spark, SF001))
    assert text.count("partial_sum(m00") >= 1 and "lambdafunction" not in text
    assert text.count("regexp_extract_all") <= 4


def test_zero_add_and_merge_make_the_counters(spark):
    df = spark.createDataFrame([(state(),)] * 5, "stat string")
    added = df.select(increment(increment("stat", "session_count"), "1_3", 2).alias("stat"))
    assert merge_packed(added).first()["stat"] == state(session_count=5, **{"1_3": 10})
    assert df.select(increment("stat", "no such field").alias("s")).first()["s"] == state()


# ---------------- page flow ----------------

FLOW_ROWS = "session_id string, action_time timestamp, event_id long, page_id long"


def brute_flow(rows, pages):
    ordered = sorted((r for r in rows if r[1] is not None), key=lambda r: (str(r[0]), r[1], r[2]))
    steps = list(zip(pages[:-1], pages[1:]))
    pairs = [(a[3], b[3]) for a, b in itertools.pairwise(ordered) if a[0] == b[0]]
    taken = [sum(p == s for p in pairs) for s in steps]
    base = [sum(r[3] == pages[0] for r in ordered), *taken[:-1]]
    return [(k, f"{a}_{b}", taken[k], base[k], taken[k] / base[k] if base[k] else 0.0) for k, (a, b) in enumerate(steps)]


@pytest.mark.parametrize("slice_seconds", [1, 60, 100000])
def test_page_conversion_of_random_sessions(spark, slice_seconds):
    import datetime as dt
    rnd = random.Random(slice_seconds)
    rows = []
    for k in range(3000):  # the hot session holds a third of the rows
        session = "hot" if k % 3 == 0 else rnd.choice(["a", "b", None, *map(str, range(200))])
        when = None if k % 97 == 0 else dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rnd.randint(0, 3000))
        rows.append((session, when, k, rnd.choice([1, 2, 3, 4, 2, None])))
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, FLOW_ROWS).repartition(7)
    pages = parse_flow("1,2,3,2,2")
    found = [tuple(r) for r in page_conversion(df, pages, ["event_id"], slice_seconds).orderBy("step").collect()]
    assert found == brute_flow(rows, pages)


def test_page_conversion_of_no_actions(spark):
    found = page_conversion(spark.createDataFrame([], FLOW_ROWS), [5, 6, 7]).collect()
    assert [tuple(r) for r in found] == [(0, "5_6", 0, 0, 0.0), (1, "6_7", 0, 0, 0.0)]
    with pytest.raises(ValueError):
        parse_flow("5")


def test_rows_of_a_session_meet_by_slice_only(spark):
    df = spark.createDataFrame([], FLOW_ROWS)
    text = formatted(page_conversion(df, [1, 2], ["event_id"]))
    keys = [re.sub(r"#\d+L?", "", k) for k in re.findall(r"hashpartitioning\(([^)]*?), \d+\)", text)]
    assert keys[:2] == ["session_id, slice", "session_id"]
    states = slice_states(df, [1, 2], ["event_id"])
    assert states.columns == ["session_id", "slice", "first_page", "last_page", "starts", "s0"]


# ---------------- categories, products, details ----------------

def test_category_counts_of_lists(spark):
    rows = [(5, None, None), (5, "5,7", ""), (None, "7,7,x,,12", "9"), (None, None, ",9,5,"), (0, None, None), (None, " 8", None)]
    df = spark.createDataFrame(rows, "click_category_id long, order_category_ids string, pay_category_ids string")
    found = {r.category_id: (r.click_count, r.order_count, r.pay_count) for r in category_counts(df).collect()}
    assert found == {5: (2, 1, 1), 7: (0, 3, 0), 12: (0, 1, 0), 9: (0, 0, 2), 0: (1, 0, 0), 8: (0, 1, 0)}
    assert category_counts(df.limit(0)).count() == 0


def test_category_counts_scan_once_and_count_before_the_shuffle(spark):
    text = formatted(catalog.category_action_counts(spark, SF001))
    assert len(re.findall(r"^\(\d+\) Scan parquet", text, flags=re.M)) == 1 and "partial_count_if" in text.replace("partial_count(if", "partial_count_if")


def test_product_clicks(spark):
    products = spark.createDataFrame([(1, "a", '{"product_status": 1}'), (2, "b", '{"product_status": 0}'), (3, "c", "{}"), (4, "d", None),
                                      (5, "e", "no json"), (6, "f", '{"product_status": "1"}'), (7, "g", '{"product_status": 1}')],
                                     "product_id long, product_name string, extend_info string")
    clicks = spark.createDataFrame([(k,) for k in [1, 1, 2, 3, 4, 5, 6, 99, None]], "click_product_id long")
    every = {r.product_id: (r.product_status, r.clicks) for r in product_clicks(clicks, products).collect()}
    assert every == {1: (1, 2), 2: (0, 1), 3: (None, 1), 4: (None, 1), 5: (None, 1), 6: (1, 1)}
    assert {r.product_id for r in product_clicks(clicks, products, 1).collect()} == {1, 6}


def test_status_is_tested_below_the_join(spark):
    text = catalog.product_status_clicks(spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    join = text.index("Join")
    assert text.index("Filter", join) and "p_size" in text[join:] and "Filter" not in text[:join]
    assert text.index("Aggregate", join) > join  # clicks are counted below it, too


def test_detail_rows_and_their_plan(spark):
    actions = [action("s1", 1, at(0)), action("s1", 1, at(5)), action("s2", 2, at(0)), action("s3", 3, at(0))]
    src = source(spark, actions, [user(1), user(2, sex="female")])
    passing = spark.createDataFrame([("s1",), ("s1",), ("s9",)], "session_id string")
    assert sorted(r.session_id for r in detail_rows(src.actions(), passing).collect()) == ["s1", "s1"]
    text = formatted(catalog.session_detail(spark, SF001))
    assert text.count("LeftSemi") >= 1 and "CartesianProduct" not in text and "NestedLoop" not in text
    assert len(re.findall(r"Join type: LeftSemi", text)) == 1


def test_bloom_filter_reaches_the_action_scan(spark, tmp_path):
    spark.range(20000).selectExpr("cast(id % 5000 AS string) AS session_id", "id AS page_id").write.parquet(str(tmp_path / "actions"))
    spark.range(5000).selectExpr("cast(id AS string) AS session_id", "id AS step_length").write.parquet(str(tmp_path / "passing"))
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        passing = spark.read.parquet(str(tmp_path / "passing")).where("step_length >= 4990")
        details = detail_rows(spark.read.parquet(str(tmp_path / "actions")), passing)
        assert "might_contain" in details._jdf.queryExecution().optimizedPlan().toString()
        assert details.count() == 40
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


# ---------------- shared report, results, stored table ----------------

def test_report_rolls_the_actions_up_once(spark):
    src = GeneratedSource(spark, SF001)
    spec = FilterSpec.of(sex="male", keywords="kw1,kw2")
    report = session_report(src, "2024-01-05", "2024-01-20", spec)
    assert stats_dict(report.counters) == stats_dict(session_stats(src, "2024-01-05", "2024-01-20", spec))
    sessions = {r.session_id for r in report.passing.collect()}
    want = [r.session_id for r in src.actions("2024-01-05", "2024-01-20").collect() if r.session_id in sessions]
    assert sorted(r.session_id for r in report.details.collect()) == sorted(want)
    # The counters read the kept sessions; the details scan the actions once and roll nothing up.
    assert "parquet" not in formatted(report.counters).lower()
    details = formatted(report.details)
    assert len(re.findall(r"^\(\d+\) Scan parquet", details, flags=re.M)) == 1 and "Aggregate" not in details


def test_results_of_other_tasks_stay(spark, tmp_path):
    path = str(tmp_path / "results")

    def run(task_id, value):
        write_task_result(spark.createDataFrame([("a", value), ("b", value)], "metric string, cnt long"), path, task_id)

    run(1, 10)
    run(2, 20)
    run(1, 10)
    run(2, 21)
    assert sorted(map(tuple, read_task_results(spark, path).collect())) == [("a", 10, 1), ("a", 21, 2), ("b", 10, 1), ("b", 21, 2)]
    write_task_result(spark.createDataFrame([], "metric string, cnt long"), path, 2)  # a run without rows leaves none
    assert sorted(map(tuple, read_task_results(spark, path).collect())) == [("a", 10, 1), ("b", 10, 1)]


def test_cli_keeps_results_of_two_tasks_and_writes_details(spark, tmp_path, capsys):
    for task in ("12", "42", "12"):
        cli_main(["--task-id", task, "--sf-dir", SF001, "--output", str(tmp_path / "stats"), "--details", str(tmp_path / "rows")])
    rows = read_task_results(spark, str(tmp_path / "stats")).collect()
    assert len(rows) == 32 and {r.task_id for r in rows} == {12, 42}
    src = GeneratedSource(spark, SF001)
    want = {(r.metric, r.cnt) for r in catalog.analyze_task(src, src.tasks(), 12).collect()}
    assert {(r.metric, r.cnt) for r in rows if r.task_id == 12} == want
    details = read_task_results(spark, str(tmp_path / "rows"), "session_id string")
    for task in (12, 42):
        sessions = details.where(f"task_id = {task}").select("session_id").distinct().count()
        assert sessions == next(r.cnt for r in rows if (r.task_id, r.metric) == (task, "session_count"))


def test_cli_reports_times_that_are_no_times(spark, capsys, monkeypatch):
    import visitscope.cli as cli

    src = source(spark, [action("s1", 1, "2018-04-09 7:00:00"), action("s1", 1, "soon")], [user(1)])
    src.action_rows.createOrReplaceTempView("bad_times")
    request = cli.TaskRequest(1, "2018-04-09", "2018-04-09", FilterSpec())
    cli.report_unparsed(spark.table("bad_times"), request)
    assert "1 of 2 actions" in capsys.readouterr().err


def test_stored_table_prunes_days_and_needs_no_session_exchange(spark, tmp_path):
    src = GeneratedSource(spark, SF001)
    stored = stored_source(spark, src.actions(), src.users(), "stored_actions_test", str(tmp_path / "actions"), buckets=4)
    try:
        assert stats_dict(session_stats(stored, "2024-01-05", "2024-01-11")) == stats_dict(session_stats(src, "2024-01-05", "2024-01-11"))
        text = formatted(session_stats(stored, "2024-01-05", "2024-01-11"))
        assert re.search(r"PartitionFilters: \[.*date#\d+ >= 2024-01-05", text) and "Bucketed: true" in text
        assert "hashpartitioning(session_id" not in text
        files = {tuple(re.search(r"date=([0-9-]+)/.*_(\d{5})\.c", f).groups()) for f in spark.table("stored_actions_test").inputFiles()}
        assert len(files) == len(spark.table("stored_actions_test").inputFiles())  # one file a day and bucket
        store_actions(src.actions().limit(0), "stored_actions_test", str(tmp_path / "other"))  # the catalog has it: nothing is written
        assert not (tmp_path / "other").exists() and spark.table("stored_actions_test").count() == src.actions().count()
    finally:
        spark.sql("DROP TABLE stored_actions_test")
