"""Registered queries: one per operator, each `(spark, sf_dir) -> DataFrame`.

Every query reads the generated tables in `sf_dir` (through the views of
`sources.testdata`) over their whole extent. Only `action_date_range` and
`task_session_stat` read a date window, because there it is the feature:
one week, and the window stored in the task.
Output columns are plain text / integers so that results compare by
value with the SQL statements in `plans.oracle`.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import STEP_BANDS, VISIT_BANDS
from ..functions import (
    after,
    before,
    date_hour,
    format_date,
    format_time,
    get_field,
    minus_seconds,
    pack,
    pad_two,
    parse_time,
    round_half_up,
    set_field,
    trim_comma,
)
from ..constants import (
    FIELD_CLICK_CATEGORY_IDS,
    FIELD_SEARCH_KEYWORDS,
    FIELD_SESSION_ID,
    FIELD_START_TIME,
    FIELD_STEP_LENGTH,
    FIELD_VISIT_LENGTH,
)
from ..operators.category import category_counts
from ..operators.filters import FilterSpec
from ..operators.flow import page_conversion, parse_flow
from ..operators.product import product_clicks
from ..operators.profile import attach_profile, match_report
from ..operators.rollup import list_text, session_core, session_records, session_records_text
from ..operators.sample import sample_row
from ..operators.stats import merge_packed, step_band, visit_band
from ..session import shared_folder
from ..sources.results import read_task_results, write_task_result
from ..sources.stored import stored_source
from ..sources.testdata import GeneratedSource, basket_actions, read_table
from .job import analyze_task, filtered_sessions, packed_user_states, session_report, session_stats, session_stats_packed
from .params import find_task, parse_task_params

# Filter values of the registered queries (task parameters).
RANGE_START = "2024-01-05"
RANGE_END = "2024-01-11"
LOOKUP_TASK_ID = 42
TASK_STAT_ID = 12
RESULT_TASK_IDS = (12, 42)
PAGE_FLOW = "1,2,3,4,5,6,7,2"
SOLD_STATUS = 1
FIRST_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE")
FIRST_NATIONS = tuple(sorted(f"NATION_{i}" for i in range(25))[:15])
KEYWORDS = ("kw1", "kw2", "kw3")
# All six filters together; each one changes the result at every scale from 0.01 on.
ALL_SIX = {
    "start_age": 5, "end_age": 54, "professionals": ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"),
    "cities": tuple(f"NATION_{i}" for i in range(18)), "sex": "male",
    "keywords": tuple(f"kw{i}" for i in range(1, 6)), "category_ids": tuple(str(i) for i in range(80)),
}
CATEGORIES = tuple(str(i) for i in range(50))

SPECS = {
    "filter_age_range": FilterSpec.of(start_age=10, end_age=40),
    "filter_professional": FilterSpec.of(professionals=FIRST_SEGMENTS),
    "filter_city": FilterSpec.of(cities=FIRST_NATIONS),
    "filter_sex": FilterSpec.of(sex="male"),
    "filter_keywords": FilterSpec.of(keywords=KEYWORDS),
    "filter_categories": FilterSpec.of(category_ids=CATEGORIES),
    "session_filter": FilterSpec.of(**ALL_SIX),
}
VISIT_METRICS = [b[0] for b in VISIT_BANDS]
STEP_METRICS = [b[0] for b in STEP_BANDS]

# The reference's mock times print the hour without padding.
UNPADDED_TIME = "yyyy-MM-dd H:mm:ss"


def _src(spark: SparkSession, sf_dir: str) -> GeneratedSource:
    return GeneratedSource(spark, sf_dir)


def _all_actions(spark, sf_dir) -> DataFrame:
    return _src(spark, sf_dir).actions()


def _action_text(actions: DataFrame) -> DataFrame:
    return actions.select(
        format_date("date").alias("date"), "user_id", "session_id", "page_id",
        format_time("action_time").alias("action_time"),
        "search_keyword", "click_category_id", "click_product_id",
        "order_category_ids", "order_product_ids", "pay_category_ids", "pay_product_ids",
        "city_id",
    )


# ---------------- sources ----------------

def action_date_range(spark, sf_dir):
    """Action rows of one week, both end days included."""
    return _action_text(_src(spark, sf_dir).actions(RANGE_START, RANGE_END))


def user_info_scan(spark, sf_dir):
    """Every user profile row."""
    return _src(spark, sf_dir).users()


def task_lookup(spark, sf_dir):
    """One task by primary key, parameters parsed."""
    return parse_task_params(find_task(_src(spark, sf_dir).tasks(), LOOKUP_TASK_ID))


def task_params(spark, sf_dir):
    """Element 0 of every parameter array of every task."""
    return parse_task_params(_src(spark, sf_dir).tasks())


def table_sample_row(spark, sf_dir):
    """L1: one (repeatable) row of the action table, of the earliest stored time.

    Ordered on the typed columns and formatted afterwards: zero-padded
    date / time text sorts exactly like the values, so only the chosen row
    is turned into text.
    """
    return _action_text(sample_row(_src(spark, sf_dir).earliest_actions()))


def user_info_sample_row(spark, sf_dir):
    """L1: one (repeatable) row of the profile table."""
    return sample_row(_src(spark, sf_dir).users(), "user_id")


def product_info_sample_row(spark, sf_dir):
    """L1: one (repeatable) row of the product table (S4 view over `part`)."""
    return sample_row(_src(spark, sf_dir).products(), "product_id")


# ---------------- session roll-up ----------------

def session_aggregate(spark, sf_dir):
    """One row per session."""
    return session_records_text(_all_actions(spark, sf_dir))


def session_keywords(spark, sf_dir):
    """A4: distinct searched keywords per session."""
    rec = session_records(_all_actions(spark, sf_dir), categories=False)
    return rec.select("session_id", list_text("search_keywords").alias("search_keywords"),
                      F.size("search_keywords").cast("bigint").alias("keyword_count"))


def session_categories(spark, sf_dir):
    """A5: distinct clicked categories per session."""
    rec = session_records(_all_actions(spark, sf_dir), keywords=False)
    return rec.select("session_id", list_text("click_category_ids").alias("click_category_ids"),
                      F.size("click_category_ids").cast("bigint").alias("category_count"))


def session_visit_length(spark, sf_dir):
    """Start, end and whole-second length of each session."""
    core = session_core(_all_actions(spark, sf_dir))
    return core.select("session_id", format_time("start_ts").alias("start_time"),
                       format_time("end_ts").alias("end_time"), "visit_length",
                       visit_band().alias("visit_band"))


def session_step_length(spark, sf_dir):
    """Action rows per session."""
    core = session_core(_all_actions(spark, sf_dir))
    return core.select("session_id", "step_length", step_band().alias("step_band"))


# ---------------- profile join ----------------

def session_user_join(spark, sf_dir):
    """Session records with the owner's profile."""
    src = _src(spark, sf_dir)
    return attach_profile(session_records_text(src.actions()), src.users())


def session_user_join_unmatched(spark, sf_dir):
    """Sessions that a join to the supplier profiles keeps and drops (owner without profile)."""
    src = _src(spark, sf_dir)
    return match_report(session_core(src.actions()), src.supplier_users())


# ---------------- filters ----------------

def _filter_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    spec = SPECS[name]

    def run(spark, sf_dir):
        return filtered_sessions(_src(spark, sf_dir), spec=spec)

    run.__name__ = name
    run.__doc__ = f"F1-F7: sessions passing {spec}"
    return run


# ---------------- statistics ----------------

def session_aggr_stat(spark, sf_dir):
    """A9-A12 (flagship): the 16 counters of all sessions."""
    return session_stats(_src(spark, sf_dir))


def session_aggr_stat_filtered(spark, sf_dir):
    """A9-A12 with all six filters."""
    return session_stats(_src(spark, sf_dir), spec=SPECS["session_filter"])


def visit_length_bands(spark, sf_dir):
    """A10: sessions per visit-length band."""
    return session_stats(_src(spark, sf_dir), metrics=VISIT_METRICS)


def step_length_bands(spark, sf_dir):
    """Sessions per step-length band."""
    return session_stats(_src(spark, sf_dir), metrics=STEP_METRICS)


def session_stat_packed(spark, sf_dir):
    """The counters as one packed text."""
    return session_stats_packed(_src(spark, sf_dir))


def task_session_stat(spark, sf_dir):
    """Entry 1 end to end: look a stored task up by id, parse it, run its filters and counters."""
    src = _src(spark, sf_dir)
    return analyze_task(src, src.tasks(), TASK_STAT_ID)


def packed_merge(spark, sf_dir):
    """The packed counters of every user merged into one state."""
    return merge_packed(packed_user_states(_src(spark, sf_dir)))


def packed_merge_by_city(spark, sf_dir):
    """The packed counters of every user merged into one state a city."""
    return merge_packed(packed_user_states(_src(spark, sf_dir)), by=["city"])


def stored_session_stat(spark, sf_dir):
    """The 16 counters of one week, from a catalog table partitioned by date and bucketed by session."""
    src = _src(spark, sf_dir)
    name = f"{spark.sparkContext.applicationId}_{zlib.crc32(sf_dir.encode()):08x}".replace("-", "_")
    stored = stored_source(spark, src.actions(), src.users(), f"visitscope_actions_{name}", f"{shared_folder(spark)}/visitscope-actions-{name}")
    return session_stats(stored, RANGE_START, RANGE_END)


def task_results(spark, sf_dir):
    """K3: counters of two stored tasks in one result table, the first task run twice."""
    src = _src(spark, sf_dir)
    path = f"{shared_folder(spark)}/visitscope-results-{zlib.crc32(sf_dir.encode()):08x}"
    for task_id in (*RESULT_TASK_IDS, RESULT_TASK_IDS[0]):
        write_task_result(analyze_task(src, src.tasks(), task_id), path, task_id)
    return read_task_results(spark, path)


# ---------------- declared in the reference without code ----------------

def session_detail(spark, sf_dir):
    """O1: action rows of the sessions that pass all six filters."""
    return _action_text(session_report(_src(spark, sf_dir), spec=SPECS["session_filter"], how=None).details)


def category_action_counts(spark, sf_dir):
    """O2: clicks, orders and payments of every category, from lists of several ids."""
    return category_counts(basket_actions(_src(spark, sf_dir).events()))


def page_flow_conversion(spark, sf_dir):
    """O3: one-step conversion over a flow of pages, actions of a session by time and event id."""
    return page_conversion(_src(spark, sf_dir).ordered_actions(), parse_flow(PAGE_FLOW), order=["event_id"])


def product_status_clicks(spark, sf_dir):
    """Clicks of the products of one status."""
    src = _src(spark, sf_dir)
    return product_clicks(src.actions(), src.products(), SOLD_STATUS)


# ---------------- column functions over the action table ----------------

def _time_texts(spark, sf_dir) -> DataFrame:
    """Action times as text in ten forms, by page: lenient, padded, and three that are no times."""
    padded, clock = "date_format(action_time, 'yyyy-MM-dd HH:mm:ss')", "date_format(action_time, 'HH:mm:ss')"
    day = "date_format(date, 'yyyy-MM-dd')"
    forms = [
        f"date_format(action_time, '{UNPADDED_TIME}')",
        f"concat({padded}, '.0')",
        f"concat({padded}, '.123')",
        "date_format(action_time, 'y-M-d H:m:s')",
        f"concat({padded}, ' x')",
        "date_format(action_time, 'yyyy/MM/dd HH:mm:ss')",
        f"concat('2024-02-30 ', {clock})",
        f"concat(' ', {day}, '  ', {clock})",
        f"concat({day}, 'T', {clock})",
    ]
    text = " ".join(f"WHEN {page} THEN {form}" for page, form in enumerate(forms))
    return _all_actions(spark, sf_dir).selectExpr("date", f"CASE page_id {text} ELSE {padded} END AS action_time_text")


def time_parse(spark, sf_dir):
    """Parse time text with one- or two-digit parts and whatever follows."""
    parsed = parse_time("action_time_text")
    return _time_texts(spark, sf_dir).select(
        "action_time_text", F.unix_timestamp(parsed).alias("epoch_seconds"), format_time(parsed).alias("normalized"))


def time_compare(spark, sf_dir):
    """Action time text against noon of its day."""
    a = _time_texts(spark, sf_dir).select("action_time_text", F.concat(format_date("date"), F.lit(" 12:00:00.0")).alias("noon_text"))
    return a.select("action_time_text", "noon_text",
                    before("action_time_text", "noon_text").alias("is_before"),
                    after("action_time_text", "noon_text").alias("is_after"))


def time_diff_seconds(spark, sf_dir):
    """Seconds from the start of the day, from two time texts."""
    a = _time_texts(spark, sf_dir).select("action_time_text", F.concat(format_date("date"), F.lit(" 0:00:00")).alias("midnight_text"))
    return a.select("action_time_text", "midnight_text",
                    minus_seconds("action_time_text", "midnight_text").alias("seconds_into_day"))


def actions_per_date_hour(spark, sf_dir):
    """C4: actions per `yyyy-MM-dd_HH` key."""
    a = _all_actions(spark, sf_dir)
    return a.groupBy(date_hour("action_time").alias("date_hour")).agg(
        F.count(F.lit(1)).alias("actions"))


def time_format(spark, sf_dir):
    """Date and time texts of every action."""
    a = _all_actions(spark, sf_dir)
    return a.select("session_id", format_date("action_time").alias("action_date"),
                    format_time("action_time").alias("action_time"))


def round_half_up_query(spark, sf_dir):
    """Line revenue rounded half-up on the exact double value."""
    li = read_table(spark, sf_dir, "lineitem")
    revenue = F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))
    return li.select(
        "l_orderkey", "l_linenumber",
        round_half_up(revenue, 2).alias("revenue_2"),
        round_half_up(revenue, 1).alias("revenue_1"),
        round_half_up(revenue, 0).alias("revenue_0"),
        round_half_up(F.col("l_extendedprice") * F.col("l_tax"), 2).alias("tax_2"),
    )


def trim_comma_query(spark, sf_dir):
    """C11: keyword buffer `a,b,` of each session trimmed to `a,b`."""
    rec = session_records(_all_actions(spark, sf_dir), categories=False)
    kws = F.col("search_keywords")
    # every keyword followed by a comma, after a leading comma
    buffer = F.concat(F.lit(","), F.array_join(kws, ","),
                      F.when(F.size(kws) > 0, F.lit(",")).otherwise(F.lit("")))
    return rec.select("session_id", buffer.alias("keyword_buffer"),
                      trim_comma(buffer).alias("search_keywords"))


def pad_two_query(spark, sf_dir):
    """Two-digit padding of hour, minute, second and user id text."""
    a = _all_actions(spark, sf_dir)
    return a.select(
        "session_id",
        pad_two(F.hour("action_time").cast("string")).alias("hh"),
        pad_two(F.minute("action_time").cast("string")).alias("mi"),
        pad_two(F.second("action_time").cast("string")).alias("ss"),
        pad_two(F.col("user_id").cast("string")).alias("user_text"),
    )


def _packed_sessions(spark, sf_dir) -> DataFrame:
    rec = session_records_text(_all_actions(spark, sf_dir))
    packed = pack([
        (FIELD_SESSION_ID, F.col("session_id")),
        (FIELD_SEARCH_KEYWORDS, F.col("search_keywords")),
        (FIELD_CLICK_CATEGORY_IDS, F.col("click_category_ids")),
        (FIELD_VISIT_LENGTH, F.col("visit_length")),
        (FIELD_STEP_LENGTH, F.col("step_length")),
        (FIELD_START_TIME, F.col("start_time")),
    ])
    return rec.select("session_id", "step_length", packed.alias("packed"))


def packed_get(spark, sf_dir):
    """Fields read back from each session's packed record."""
    p = _packed_sessions(spark, sf_dir)
    return p.select(
        "packed",
        get_field("packed", FIELD_VISIT_LENGTH).alias("visit_length"),
        get_field("packed", FIELD_STEP_LENGTH).alias("step_length"),
        get_field("packed", FIELD_SEARCH_KEYWORDS).alias("search_keywords"),
        get_field("packed", "age").alias("age"),
    )


def packed_set(spark, sf_dir):
    """C14: step length incremented inside the packed record; unknown field untouched."""
    p = _packed_sessions(spark, sf_dir)
    return p.select(
        "session_id",
        set_field("packed", FIELD_STEP_LENGTH, (F.col("step_length") + 1).cast("string"))
        .alias("packed_next"),
        set_field("packed", "age", F.lit("0")).alias("packed_unknown"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "action_date_range": action_date_range,
    "user_info_scan": user_info_scan,
    "task_lookup": task_lookup,
    "task_params": task_params,
    "table_sample_row": table_sample_row,
    "user_info_sample_row": user_info_sample_row,
    "product_info_sample_row": product_info_sample_row,
    "session_aggregate": session_aggregate,
    "session_keywords": session_keywords,
    "session_categories": session_categories,
    "session_visit_length": session_visit_length,
    "session_step_length": session_step_length,
    "session_user_join": session_user_join,
    "session_user_join_unmatched": session_user_join_unmatched,
    **{name: _filter_query(name) for name in SPECS},
    "session_aggr_stat": session_aggr_stat,
    "session_aggr_stat_filtered": session_aggr_stat_filtered,
    "visit_length_bands": visit_length_bands,
    "step_length_bands": step_length_bands,
    "session_stat_packed": session_stat_packed,
    "task_session_stat": task_session_stat,
    "packed_merge": packed_merge,
    "packed_merge_by_city": packed_merge_by_city,
    "stored_session_stat": stored_session_stat,
    "task_results": task_results,
    "session_detail": session_detail,
    "category_action_counts": category_action_counts,
    "page_flow_conversion": page_flow_conversion,
    "product_status_clicks": product_status_clicks,
    "time_parse": time_parse,
    "time_compare": time_compare,
    "time_diff_seconds": time_diff_seconds,
    "actions_per_date_hour": actions_per_date_hour,
    "time_format": time_format,
    "round_half_up": round_half_up_query,
    "trim_comma": trim_comma_query,
    "pad_two": pad_two_query,
    "packed_get": packed_get,
    "packed_set": packed_set,
}
