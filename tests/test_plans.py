"""Physical plan checks: pushdown, pruning, shuffle count, no Python on the hot path."""

from __future__ import annotations

import re
from conftest import SF001
from visitscope.plans import catalog
from visitscope.plans.job import session_stat_slots
from visitscope.operators.filters import FilterSpec
from visitscope.sources.testdata import GeneratedSource


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    import io
    import contextlib

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_date_window_reaches_parquet(spark):
    df = GeneratedSource(spark, SF001).actions("2024-01-05", "2024-01-11")
    text = formatted(df)
    assert "GreaterThanOrEqual(ts,2024-01-05T00:00)" in text
    assert "LessThan(ts,2024-01-12T00:00)" in text


def test_stats_plan_shape(spark):
    spec = FilterSpec.of(professionals="AUTOMOBILE", keywords="kw1")
    df = session_stat_slots(GeneratedSource(spark, SF001), "2024-01-05", "2024-01-11", spec)
    text = formatted(df)
    # events scan reads only the columns the roll-up needs
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>" in text
    # profile predicate pushed into the customer scan
    assert "In(c_mktsegment, [AUTOMOBILE])" in text or "EqualTo(c_mktsegment,AUTOMOBILE)" in text
    # partial aggregation before each exchange
    assert "partial_min(user_id" in text and "partial_count(1)" in text
    # exchanges: by session, by user, the single-row total (+ an optional profile shuffle)
    assert text.count("hashpartitioning(session_id") == 1
    assert text.count("hashpartitioning(user_id") <= 2
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_no_python_udf_in_any_query(spark):
    for name, fn in catalog.QUERIES.items():
        text = formatted(fn(spark, SF001))
        # lambdafunction: higher-order functions run interpreted, outside codegen
        for marker in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                       "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin",
                       "lambdafunction"):
            assert marker not in text, (name, marker)


def test_list_building_spreads_hot_sessions(spark):
    # one scan; first exchange on (session, value), then on session;
    # no join between separately built parts; one list expands its own kind only
    for name, keys in {"session_keywords": ["keyword"], "session_categories": ["category"], "trim_comma": ["keyword"],
                       "session_aggregate": ["keyword", "category"]}.items():
        text = formatted(catalog.QUERIES[name](spark, SF001))
        assert len(re.findall(r"^\(\d+\) Scan parquet", text, flags=re.M)) == 1
        assert "Join" not in text
        first, last = re.findall(r"hashpartitioning\(([^)]*?), \d+\)", text)[:2]
        assert re.sub(r"#\d+L?", "", first) == ", ".join(["session_id", *keys]), name
        assert re.sub(r"#\d+L?", "", last) == "session_id", name


def test_sample_row_scans_one_narrow_column(spark):
    text = formatted(catalog.QUERIES["table_sample_row"](spark, SF001))
    assert "EqualNullSafe(ts," in text or "EqualTo(ts," in text
    assert "EqualNullSafe(c_custkey," in formatted(catalog.QUERIES["user_info_sample_row"](spark, SF001)).replace("EqualTo", "EqualNullSafe")


def test_no_query_but_the_ranges_reads_a_window(spark):
    for name, fn in catalog.QUERIES.items():
        windowed = "GreaterThanOrEqual(ts," in formatted(fn(spark, SF001))
        assert windowed == (name in ("action_date_range", "task_session_stat")), name


def test_packed_get_runs_one_expression_a_field(spark):
    plan = catalog.packed_get(spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract") + plan.count("regexp_substr") <= 4 and "RLIKE" not in plan
