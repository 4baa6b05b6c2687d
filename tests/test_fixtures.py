"""Hand-written edge fixtures (FIXTURES.md section 3, X1-X20)."""

from __future__ import annotations

import pytest
from pyspark.sql import Row

from helpers import DAY, action, at, source, stats_dict, user
from visitscope.constants import stat_metrics
from visitscope.operators.filters import FilterSpec
from visitscope.operators.rollup import session_records, session_records_text
from visitscope.plans.job import filtered_sessions, session_stats
from visitscope.plans.params import TaskRequest, load_task_request, parse_task_params
from visitscope.schemas import TASK

VISIT_EDGES = [0, 1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801]


def _length_sessions(lengths):
    rows = []
    for i, length in enumerate(lengths):
        rows.append(action(f"s{i}", 1, at(0)))
        if length:
            rows.append(action(f"s{i}", 1, at(length)))
    return rows


def test_x1_visit_band_edges(spark):
    src = source(spark, _length_sessions(VISIT_EDGES), [user(1)])
    got = stats_dict(session_stats(src, DAY, DAY))
    assert got["session_count"] == 18
    expected = {"1s_3s": 2, "4s_6s": 2, "7s_9s": 2, "10s_30s": 2, "30s_60s": 2,
                "1m_3m": 2, "3m_10m": 2, "10m_30m": 2, "30m": 1}
    for k, v in expected.items():
        assert got[k] == v, k
    # the 0-second session sits in no visit band
    assert sum(expected.values()) == 17


def test_x2_step_band_edges(spark):
    rows = []
    for i, steps in enumerate([1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61]):
        rows += [action(f"s{i}", 1, at(j)) for j in range(steps)]
    got = stats_dict(session_stats(source(spark, rows, [user(1)]), DAY, DAY))
    assert [got[m] for m in ["1_3", "4_6", "7_9", "10_30", "30_60", "60"]] == [2, 2, 2, 2, 2, 1]
    assert got["session_count"] == 11


def test_x3_no_actions_gives_sixteen_zeros(spark):
    got = session_stats(source(spark, [], [user(1)]), DAY, DAY).collect()
    assert [r["metric"] for r in got] == stat_metrics()
    assert all(r["cnt"] == 0 for r in got)


def test_x4_keyword_inside_another_is_kept(spark):
    rows = [action("s", 1, at(0), keyword="新辣道鱼火锅"), action("s", 1, at(5), keyword="火锅")]
    rec = session_records(source(spark, rows, [user(1)]).actions(DAY, DAY)).collect()[0]
    assert sorted(rec["search_keywords"]) == sorted(["新辣道鱼火锅", "火锅"])


def test_x5_categories_distinct_nulls_ignored(spark):
    rows = [action("s", 1, at(i), category=c) for i, c in enumerate([5, 15, 5, None])]
    rec = session_records(source(spark, rows, [user(1)]).actions(DAY, DAY)).collect()[0]
    assert rec["click_category_ids"] == [5, 15]
    text = session_records_text(source(spark, rows, [user(1)]).actions(DAY, DAY)).collect()[0]
    assert text["click_category_ids"] == "5,15"


def test_x6_session_without_search_or_click(spark):
    rows = [action("s", 1, at(0)), action("s", 1, at(3), keyword="")]
    src = source(spark, rows, [user(1)])
    rec = session_records(src.actions(DAY, DAY)).collect()[0]
    assert rec["search_keywords"] == [] and rec["click_category_ids"] == []
    assert filtered_sessions(src, DAY, DAY, FilterSpec.of(keywords="a")).count() == 0
    assert filtered_sessions(src, DAY, DAY, FilterSpec()).count() == 1


def test_x7_one_digit_hour(spark):
    rows = [action("s", 1, "2018-04-09 7:05:09"), action("s", 1, "2018-04-09 17:05:09")]
    rec = session_records(source(spark, rows, [user(1)]).actions(DAY, DAY)).collect()[0]
    assert rec["visit_length"] == 36000


def test_x8_unknown_user_dropped(spark):
    rows = [action("a", 1, at(0)), action("b", 2, at(0))]
    got = stats_dict(session_stats(source(spark, rows, [user(1)]), DAY, DAY))
    assert got["session_count"] == 1


def test_x9_no_filter_keeps_all(spark):
    rows = [action(f"s{i}", i, at(0)) for i in range(5)]
    users = [user(i, age=i * 10, sex="female" if i % 2 else "male") for i in range(5)]
    got = stats_dict(session_stats(source(spark, rows, users), DAY, DAY, FilterSpec()))
    assert got["session_count"] == 5


def test_x10_start_age_only_is_ignored(spark):
    rows = [action(f"s{i}", i, at(0)) for i in range(3)]
    users = [user(0, age=5), user(1, age=50), user(2, age=90)]
    spec = FilterSpec.of(start_age=60)
    assert not spec.has_age_range
    got = stats_dict(session_stats(source(spark, rows, users), DAY, DAY, spec))
    assert got["session_count"] == 3


def test_x11_age_range_inclusive(spark):
    rows = [action(f"s{i}", i, at(0)) for i in range(4)]
    users = [user(0, age=9), user(1, age=10), user(2, age=20), user(3, age=21)]
    got = filtered_sessions(source(spark, rows, users), DAY, DAY, FilterSpec.of(start_age=10, end_age=20))
    assert sorted(r["age"] for r in got.collect()) == [10, 20]


def test_x12_city_list(spark):
    rows = [action(f"s{i}", i, at(0)) for i in range(3)]
    users = [user(0, city="b"), user(1, city="c"), user(2, city=None)]
    got = filtered_sessions(source(spark, rows, users), DAY, DAY, FilterSpec.of(cities="a,b"))
    assert [r["user_id"] for r in got.collect()] == [0]


def test_x13_both_dates_included(spark):
    rows = [action("a", 1, "2018-04-08 23:59:59", date="2018-04-08"),
            action("b", 1, "2018-04-09 0:00:00", date="2018-04-09"),
            action("c", 1, "2018-04-10 23:59:59", date="2018-04-10"),
            action("d", 1, "2018-04-11 0:00:00", date="2018-04-11")]
    src = source(spark, rows, [user(1)])
    got = stats_dict(session_stats(src, "2018-04-09", "2018-04-10"))
    assert got["session_count"] == 2


def test_x14_partition_count_does_not_change_stats(spark):
    rows = []
    for i in range(60):
        rows += [action(f"s{i}", i % 7, at(j * (i + 1)), keyword=f"k{j % 3}", category=j)
                 for j in range(i % 9 + 1)]
    users = [user(i, age=10 * i) for i in range(7)]
    a = stats_dict(session_stats(source(spark, rows, users, partitions=1), DAY, DAY))
    b = stats_dict(session_stats(source(spark, rows, users, partitions=50), DAY, DAY))
    assert a == b and a["session_count"] == 60


def _task_df(spark, params: dict[int, str]):
    rows = [Row(task_id=k, task_name=f"t{k}", create_time=None, start_time=None, finish_time=None,
                task_type="session", task_status="created", task_param=v) for k, v in params.items()]
    return spark.createDataFrame(rows, TASK)


def test_x19_unknown_task_and_missing_start_date(spark):
    tasks = _task_df(spark, {1: '{"endDate": ["2018-04-09"]}'})
    with pytest.raises(LookupError):
        load_task_request(tasks, 99)
    with pytest.raises(ValueError, match="startDate"):
        load_task_request(tasks, 1)


def test_x20_empty_sex_means_no_filter(spark):
    tasks = _task_df(spark, {
        1: '{"startDate": ["2018-04-09"], "endDate": ["2018-04-09"], "sex": [""]}',
        2: '{"startDate": ["2018-04-09"], "endDate": ["2018-04-09"], "sex": []}',
    })
    for tid in (1, 2):
        req = load_task_request(tasks, tid)
        assert req.spec.sex is None
        assert req.spec == FilterSpec()


def test_task_params_element_zero_and_lists(spark):
    tasks = _task_df(spark, {
        7: ('{"startDate": ["2018-04-09", "x"], "endDate": ["2018-04-10"], "startAge": ["10"], '
            '"endAge": ["20"], "professionals": ["p1,p2"], "cities": ["c1"], "sex": ["male"], '
            '"keywords": ["火锅,蛋糕"], "categoryIds": ["1,2,3"]}'),
    })
    row = parse_task_params(tasks).collect()[0]
    assert row["start_date"] == "2018-04-09" and row["end_age"] == "20"
    req = TaskRequest.from_params(row.asDict(), task_id=7)
    assert req.spec == FilterSpec(start_age=10, end_age=20, professionals=("p1", "p2"),
                                  cities=("c1",), sex="male", keywords=("火锅", "蛋糕"),
                                  category_ids=("1", "2", "3"))


def test_task_drives_job(spark):
    rows = [action("a", 1, at(0), keyword="火锅"), action("a", 1, at(20)),
            action("b", 2, at(0), keyword="蛋糕"), action("c", 3, at(0), keyword="火锅")]
    users = [user(1, age=15), user(2, age=15), user(3, age=45)]
    src = source(spark, rows, users)
    tasks = _task_df(spark, {
        5: ('{"startDate": ["2018-04-09"], "endDate": ["2018-04-09"], "startAge": ["10"], '
            '"endAge": ["20"], "keywords": ["火锅"]}'),
    })
    from visitscope.plans.job import analyze_task
    got = stats_dict(analyze_task(src, tasks, 5))
    assert got["session_count"] == 1 and got["10s_30s"] == 1 and got["1_3"] == 1


@pytest.mark.parametrize("spec", [
    FilterSpec.of(keywords="k1"),
    FilterSpec.of(category_ids="3,5"),
    FilterSpec.of(keywords="k0,k2", category_ids="4"),
    FilterSpec(),
])
def test_list_predicates_agree_with_hit_flags(spark, spec):
    from visitscope.operators.filters import session_hit_predicate, session_list_predicate
    from visitscope.operators.rollup import session_core

    rows = []
    for i in range(30):
        rows += [action(f"s{i}", 1, at(j), keyword=f"k{(i + j) % 5}" if j % 2 else None,
                        category=(i * j) % 9 if j % 3 == 0 else None) for j in range(i % 6 + 1)]
    actions = source(spark, rows, [user(1)]).actions(DAY, DAY)
    by_list = {r["session_id"] for r in session_records(actions).where(session_list_predicate(spec)).collect()}
    by_flag = {r["session_id"] for r in session_core(actions, spec).where(session_hit_predicate(spec)).collect()}
    assert by_list == by_flag
