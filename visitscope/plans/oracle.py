"""Independent SQL (DuckDB dialect) for each registered query.

Written directly against the generated tables, row by row from the
definitions: sessions are joined to profiles *before* counting (the Spark
plan pre-aggregates per user instead), lists are built with `list`
aggregates, bands with plain CASE logic.
"""

from __future__ import annotations

import datetime as dt

from ..constants import SESSION_COUNT, STEP_BANDS, VISIT_BANDS
from .catalog import (
    ALL_SIX,
    CATEGORIES,
    FIRST_NATIONS,
    FIRST_SEGMENTS,
    KEYWORDS,
    LOOKUP_TASK_ID,
    PAGE_FLOW,
    RANGE_END,
    RANGE_START,
    RESULT_TASK_IDS,
    SOLD_STATUS,
    TASK_STAT_ID,
)


def _ev(where: str = "") -> str:
    return f"""ev AS (
  SELECT event_id, user_id, event_type, date_trunc('second', ts) AS t,
         TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events {where}
)"""


_UVA = """uva AS (
  SELECT CAST(t AS DATE) AS date, user_id,
         CAST(user_id % 5 AS VARCHAR) || '_' || CASE user_id % 5
           WHEN 0 THEN strftime(t, '%Y%m%d')
           WHEN 1 THEN strftime(t, '%Y%m%d') || 'q' || CAST(hour(t) // 6 AS VARCHAR)
           WHEN 2 THEN strftime(t, '%Y%m%d%H')
           ELSE CAST(CAST(floor(epoch(t) / 600) AS BIGINT) AS VARCHAR) END AS session_id,
         event_id % 10 AS page_id,
         t AS action_time,
         CASE WHEN event_type = 'view' THEN 'kw' || CAST(k % 10 AS VARCHAR) END AS search_keyword,
         CASE WHEN event_type = 'click' THEN k END AS click_category_id,
         CASE WHEN event_type = 'click' THEN event_id % 100 END AS click_product_id,
         CASE WHEN event_type = 'signup' THEN CAST(k AS VARCHAR) END AS order_category_ids,
         CASE WHEN event_type = 'signup' THEN CAST(event_id % 100 AS VARCHAR) END AS order_product_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(k AS VARCHAR) END AS pay_category_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(event_id % 100 AS VARCHAR) END AS pay_product_ids,
         user_id % 10 AS city_id
  FROM ev
)"""

_UI = """ui AS (
  SELECT c_custkey AS user_id, c_name AS username, c_name AS name,
         CAST(c_custkey % 60 AS INTEGER) AS age, c_mktsegment AS professional,
         n_name AS city, CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""

_SESS = """sess AS (
  SELECT session_id,
         min(user_id) AS user_id,
         min(action_time) AS start_ts,
         max(action_time) AS end_ts,
         count(*) AS step_length,
         CAST(epoch(max(action_time)) - epoch(min(action_time)) AS BIGINT) AS visit_length,
         list(DISTINCT search_keyword) FILTER (WHERE search_keyword IS NOT NULL AND search_keyword <> '') AS kw_list,
         list(DISTINCT click_category_id) FILTER (WHERE click_category_id IS NOT NULL) AS cat_list
  FROM uva GROUP BY session_id
)"""

_SESS_TEXT = """st AS (
  SELECT session_id, user_id,
         coalesce(array_to_string(list_sort(kw_list), ','), '') AS search_keywords,
         coalesce(array_to_string(list_sort(cat_list), ','), '') AS click_category_ids,
         visit_length, step_length,
         strftime(start_ts, '%Y-%m-%d %H:%M:%S') AS start_time,
         strftime(end_ts, '%Y-%m-%d %H:%M:%S') AS end_time,
         kw_list, cat_list
  FROM sess
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _sessions() -> str:
    return _with(_ev(), _UVA, _SESS, _SESS_TEXT, _UI)


def _all_actions() -> str:
    return _with(_ev(), _UVA)


def _quote_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _band_case(col: str, bands) -> str:
    parts = []
    for name, lo, hi in bands:
        cond = f"{col} >= {lo}" if hi is None else f"{col} BETWEEN {lo} AND {hi}"
        parts.append(f"WHEN {cond} THEN '{name}'")
    return "CASE " + " ".join(parts) + " END"


def _stats_sql(where: str, metrics: list[str] | None = None, prefix: str | None = None) -> str:
    rows = [(SESSION_COUNT, "TRUE")]
    for name, lo, hi in VISIT_BANDS:
        rows.append((name, f"visit_length >= {lo}" if hi is None else f"visit_length BETWEEN {lo} AND {hi}"))
    for name, lo, hi in STEP_BANDS:
        rows.append((name, f"step_length >= {lo}" if hi is None else f"step_length BETWEEN {lo} AND {hi}"))
    if metrics is not None:
        rows = [r for r in rows if r[0] in metrics]
    body = "\nUNION ALL\n".join(
        f"SELECT '{name}' AS metric, CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS cnt FROM passed"
        for name, cond in rows)
    return ((prefix or _sessions())
            + f", passed AS (SELECT st.* , ui.age, ui.professional, ui.city, ui.sex "
              f"FROM st JOIN ui USING (user_id) WHERE {where})\n" + body)


def _packed_stat_sql(by: str = "") -> str:
    rows = [(SESSION_COUNT, "TRUE")]
    for name, lo, hi in VISIT_BANDS:
        rows.append((name, f"visit_length >= {lo}" if hi is None else f"visit_length BETWEEN {lo} AND {hi}"))
    for name, lo, hi in STEP_BANDS:
        rows.append((name, f"step_length >= {lo}" if hi is None else f"step_length BETWEEN {lo} AND {hi}"))
    parts = " || '|' || ".join(
        f"'{name}=' || CAST(count(*) FILTER (WHERE {cond}) AS VARCHAR)" for name, cond in rows)
    return (_sessions()
            + ", passed AS (SELECT st.*, ui.city FROM st JOIN ui USING (user_id))\n"
            + f"SELECT {by + ', ' if by else ''}{parts} AS stat FROM passed" + (f" GROUP BY {by}" if by else ""))


def _week_stats_sql() -> str:
    window = f"WHERE CAST(ts AS DATE) BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}'"
    return _stats_sql("TRUE", prefix=_with(_ev(window), _UVA, _SESS, _SESS_TEXT, _UI))


def _flow_sql() -> str:
    pages = [int(p) for p in PAGE_FLOW.split(",")]
    steps = list(zip(pages[:-1], pages[1:]))
    counts = [f"count(*) FILTER (WHERE page_id = {a} AND next_page = {b}) AS v{k}" for k, (a, b) in enumerate(steps)]
    shares = [f"SELECT {k}::INT AS step, '{a}_{b}' AS page_split, v{k} AS visits, {'starts' if k == 0 else f'v{k - 1}'} AS base FROM total"
              for k, (a, b) in enumerate(steps)]
    return (_with(_ev(), _UVA.replace("event_id % 10 AS page_id", "event_id % 10 AS page_id, event_id"),
                  "nx AS (SELECT page_id, lead(page_id) OVER (PARTITION BY session_id ORDER BY action_time, event_id) AS next_page FROM uva)",
                  f"total AS (SELECT count(*) FILTER (WHERE page_id = {pages[0]}) AS starts, {', '.join(counts)} FROM nx)")
            + "SELECT *, CASE WHEN base = 0 THEN 0.0::DOUBLE ELSE visits::DOUBLE / base::DOUBLE END AS conversion_rate FROM ("
            + " UNION ALL ".join(shares) + ") x")


_CATEGORY_SQL = """WITH e AS (
  SELECT event_type, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
c AS (
  SELECT k AS category_id, 'click' AS kind FROM e WHERE event_type = 'click'
  UNION ALL SELECT unnest([k, (k + 7) % 100]), 'order' FROM e WHERE event_type = 'signup'
  UNION ALL SELECT k, 'order' FROM e WHERE event_type = 'signup' AND k % 3 = 0
  UNION ALL SELECT unnest([k, (k * 3) % 120]), 'pay' FROM e WHERE event_type = 'purchase')
SELECT category_id, count(*) FILTER (WHERE kind = 'click') AS click_count, count(*) FILTER (WHERE kind = 'order') AS order_count,
       count(*) FILTER (WHERE kind = 'pay') AS pay_count
FROM c WHERE category_id IS NOT NULL GROUP BY category_id"""


_AGE = "age BETWEEN 10 AND 40"
_PROF = f"professional IN ({_quote_list(FIRST_SEGMENTS)})"
_CITY = f"city IN ({_quote_list(FIRST_NATIONS)})"
_SEX = "sex = 'male'"
_KW = f"list_has_any(kw_list, [{_quote_list(KEYWORDS)}])"
_CAT = f"list_has_any(cat_list, [{', '.join(CATEGORIES)}])"

FILTERS = {
    "filter_age_range": _AGE,
    "filter_professional": _PROF,
    "filter_city": _CITY,
    "filter_sex": _SEX,
    "filter_keywords": _KW,
    "filter_categories": _CAT,
    "session_filter": " AND ".join([
        f"age BETWEEN {ALL_SIX['start_age']} AND {ALL_SIX['end_age']}",
        f"professional IN ({_quote_list(ALL_SIX['professionals'])})",
        f"city IN ({_quote_list(ALL_SIX['cities'])})",
        f"sex = '{ALL_SIX['sex']}'",
        f"list_has_any(kw_list, [{_quote_list(ALL_SIX['keywords'])}])",
        f"list_has_any(cat_list, [{', '.join(ALL_SIX['category_ids'])}])",
    ]),
}


def _filter_sql(where: str) -> str:
    return (_sessions()
            + "SELECT st.session_id, st.user_id, st.visit_length, st.step_length, st.start_time, "
              "ui.age, ui.professional, ui.city, ui.sex\n"
              f"FROM st JOIN ui USING (user_id) WHERE {where}")


_ACTION_TEXT = """SELECT strftime(date, '%Y-%m-%d') AS date, user_id, session_id, page_id,
       strftime(action_time, '%Y-%m-%d %H:%M:%S') AS action_time,
       search_keyword, click_category_id, click_product_id,
       order_category_ids, order_product_ids, pay_category_ids, pay_product_ids, city_id
FROM uva"""

_TASKS = """tp AS (
  SELECT c_custkey AS task_id, 'sessions like ' || c_name AS task_name,
         strftime(DATE '2024-01-01' + CAST(c_custkey % 21 AS INTEGER), '%Y-%m-%d') AS start_date,
         strftime(DATE '2024-01-01' + CAST(c_custkey % 21 AS INTEGER) + 6, '%Y-%m-%d') AS end_date,
         CAST(greatest(CAST(c_custkey % 60 AS INTEGER) - 15, 0) AS VARCHAR) AS start_age,
         CASE WHEN c_acctbal >= 0 THEN CAST(CAST(c_custkey % 60 AS INTEGER) + 15 AS VARCHAR) END AS end_age,
         c_mktsegment AS professionals,
         CASE WHEN c_acctbal > 5000 THEN n_name END AS cities,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL
              WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex,
         CASE WHEN c_mktsegment <> 'AUTOMOBILE' THEN 'kw' || CAST((c_custkey + 0) % 10 AS VARCHAR) || ',' || 'kw' || CAST((c_custkey + 3) % 10 AS VARCHAR) || ',' || 'kw' || CAST((c_custkey + 6) % 10 AS VARCHAR) END AS keywords,
         CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST((c_nationkey + 0) % 100 AS VARCHAR) || ',' || CAST((c_nationkey + 10) % 100 AS VARCHAR) || ',' || CAST((c_nationkey + 20) % 100 AS VARCHAR) || ',' || CAST((c_nationkey + 30) % 100 AS VARCHAR) || ',' || CAST((c_nationkey + 40) % 100 AS VARCHAR) || ',' || CAST((c_nationkey + 50) % 100 AS VARCHAR) || ',' || CAST((c_nationkey + 60) % 100 AS VARCHAR) || ',' || CAST((c_nationkey + 70) % 100 AS VARCHAR) || ',' || CAST((c_nationkey + 80) % 100 AS VARCHAR) || ',' || CAST((c_nationkey + 90) % 100 AS VARCHAR) END AS category_ids
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""

def _round_sql(x: str, scale: int) -> str:
    """Half-up rounding on the decimal digits of the stored double, as the database prints them.

    Forty digits after the point are more than the distance of any double from a tie.
    """
    digits = f"printf('%.40f', abs({x}))"
    whole, rest = f"split_part({digits}, '.', 1)", f"split_part({digits}, '.', 2)"
    cut = f"CAST({whole} || substr({rest}, 1, {scale}) AS HUGEINT)"
    up = f"CASE WHEN substr({rest}, {scale + 1}, 1) >= '5' THEN 1 ELSE 0 END"
    return f"(CAST({cut} + {up} AS DOUBLE) / CAST({10 ** scale} AS DOUBLE) * sign({x}))"


_REV = "(l_extendedprice * (CAST(1.0 AS DOUBLE) - l_discount))"

# Time texts in ten forms by page; which are times is stated, not parsed.
_TIME_TEXT = """tt AS (
  SELECT date, action_time, page_id NOT IN (5, 6, 8) AS is_time, CASE page_id
    WHEN 0 THEN strftime(action_time, '%Y-%m-%d %-H:%M:%S')
    WHEN 1 THEN strftime(action_time, '%Y-%m-%d %H:%M:%S') || '.0'
    WHEN 2 THEN strftime(action_time, '%Y-%m-%d %H:%M:%S') || '.123'
    WHEN 3 THEN strftime(action_time, '%Y-%-m-%-d %-H:%-M:%-S')
    WHEN 4 THEN strftime(action_time, '%Y-%m-%d %H:%M:%S') || ' x'
    WHEN 5 THEN strftime(action_time, '%Y/%m/%d %H:%M:%S')
    WHEN 6 THEN '2024-02-30 ' || strftime(action_time, '%H:%M:%S')
    WHEN 7 THEN ' ' || strftime(action_time, '%Y-%m-%d') || '  ' || strftime(action_time, '%H:%M:%S')
    WHEN 8 THEN strftime(action_time, '%Y-%m-%d') || 'T' || strftime(action_time, '%H:%M:%S')
    ELSE strftime(action_time, '%Y-%m-%d %H:%M:%S') END AS action_time_text
  FROM uva
)
"""

_PACKED = """pk AS (
  SELECT session_id, step_length,
         'sessionid=' || session_id || '|searchKeywords=' || search_keywords ||
         '|clickCategoryIds=' || click_category_ids || '|visitLength=' || CAST(visit_length AS VARCHAR) ||
         '|stepLength=' || CAST(step_length AS VARCHAR) || '|startTime=' || start_time AS packed
  FROM st
)"""


def _task_stat_sql(task_id: int) -> str:
    def param(name: str) -> str:
        return f"(SELECT {name} FROM tp WHERE task_id = {task_id})"

    window = (f"WHERE ts >= CAST({param('start_date')} AS TIMESTAMP) "
              f"AND ts < CAST({param('end_date')} AS TIMESTAMP) + INTERVAL 1 DAY")
    prefix = _with(_TASKS, _ev(window), _UVA, _SESS, _SESS_TEXT, _UI)
    where = " AND ".join([
        f"({param('start_age')} IS NULL OR {param('end_age')} IS NULL OR age BETWEEN "
        f"CAST({param('start_age')} AS INTEGER) AND CAST({param('end_age')} AS INTEGER))",
        f"({param('professionals')} IS NULL OR list_contains(string_split({param('professionals')}, ','), professional))",
        f"({param('cities')} IS NULL OR list_contains(string_split({param('cities')}, ','), city))",
        f"({param('sex')} IS NULL OR sex = {param('sex')})",
        f"({param('keywords')} IS NULL OR list_has_any(kw_list, string_split({param('keywords')}, ',')))",
        f"({param('category_ids')} IS NULL OR list_has_any(list_transform(cat_list, lambda c: CAST(c AS VARCHAR)), "
        f"string_split({param('category_ids')}, ',')))",
    ])
    return _stats_sql(where, prefix=prefix)


ORACLE: dict[str, str] = {
    "action_date_range": _with(_ev(
        f"WHERE ts >= TIMESTAMP '{RANGE_START}' AND ts < TIMESTAMP '{RANGE_START}' + INTERVAL "
        f"{(dt.date.fromisoformat(RANGE_END) - dt.date.fromisoformat(RANGE_START)).days + 1} DAY"), _UVA)
        + _ACTION_TEXT,
    "user_info_scan": _with(_UI) + "SELECT user_id, username, name, age, professional, city, sex FROM ui",
    "task_lookup": _with(_TASKS) + f"SELECT * FROM tp WHERE task_id = {LOOKUP_TASK_ID}",
    "task_params": _with(_TASKS) + "SELECT * FROM tp",
    "table_sample_row": _with(_ev("WHERE ts = (SELECT min(ts) FROM events)"), _UVA) + "SELECT * FROM (" + _ACTION_TEXT + ") x "
        "ORDER BY date NULLS FIRST, user_id NULLS FIRST, session_id NULLS FIRST, page_id NULLS FIRST, "
        "action_time NULLS FIRST, search_keyword NULLS FIRST, click_category_id NULLS FIRST, "
        "click_product_id NULLS FIRST, order_category_ids NULLS FIRST, order_product_ids NULLS FIRST, "
        "pay_category_ids NULLS FIRST, pay_product_ids NULLS FIRST, city_id NULLS FIRST LIMIT 1",
    "user_info_sample_row": _with(_UI) + "SELECT user_id, username, name, age, professional, city, sex FROM ui "
        "ORDER BY user_id NULLS FIRST, username NULLS FIRST, name NULLS FIRST, age NULLS FIRST, "
        "professional NULLS FIRST, city NULLS FIRST, sex NULLS FIRST LIMIT 1",
    "product_info_sample_row": "SELECT * FROM (SELECT p_partkey AS product_id, p_name AS product_name, "
        "CASE WHEN p_size IS NULL THEN '{}' ELSE '{\"product_status\":' || CAST(p_size % 2 AS VARCHAR) || '}' END "
        "AS extend_info FROM part) x ORDER BY product_id NULLS FIRST, product_name NULLS FIRST, "
        "extend_info NULLS FIRST LIMIT 1",
    "session_aggregate": _sessions()
        + "SELECT session_id, user_id, search_keywords, click_category_ids, visit_length, step_length, start_time FROM st",
    "session_keywords": _sessions()
        + "SELECT session_id, search_keywords, CAST(coalesce(len(kw_list), 0) AS BIGINT) AS keyword_count FROM st",
    "session_categories": _sessions()
        + "SELECT session_id, click_category_ids, CAST(coalesce(len(cat_list), 0) AS BIGINT) AS category_count FROM st",
    "session_visit_length": _sessions()
        + f"SELECT session_id, start_time, end_time, visit_length, {_band_case('visit_length', VISIT_BANDS)} AS visit_band FROM st",
    "session_step_length": _sessions()
        + f"SELECT session_id, step_length, {_band_case('step_length', STEP_BANDS)} AS step_band FROM st",
    "session_user_join": _sessions()
        + "SELECT st.user_id, st.session_id, st.search_keywords, st.click_category_ids, st.visit_length, "
          "st.step_length, st.start_time, ui.age, ui.professional, ui.city, ui.sex FROM st JOIN ui USING (user_id)",
    "session_user_join_unmatched": _sessions()
        + "SELECT CAST(count(*) AS BIGINT) AS sessions, "
          "CAST(count(*) FILTER (WHERE user_id IN (SELECT s_suppkey FROM supplier)) AS BIGINT) AS matched, "
          "CAST(count(*) FILTER (WHERE user_id IS NULL OR user_id NOT IN (SELECT s_suppkey FROM supplier)) AS BIGINT) AS dropped "
          "FROM st",
    **{name: _filter_sql(where) for name, where in FILTERS.items()},
    "session_aggr_stat": _stats_sql("TRUE"),
    "session_aggr_stat_filtered": _stats_sql(FILTERS["session_filter"]),
    "visit_length_bands": _stats_sql("TRUE", [b[0] for b in VISIT_BANDS]),
    "step_length_bands": _stats_sql("TRUE", [b[0] for b in STEP_BANDS]),
    "session_stat_packed": _packed_stat_sql(),
    "task_session_stat": _task_stat_sql(TASK_STAT_ID),
    "packed_merge": _packed_stat_sql(),
    "packed_merge_by_city": _packed_stat_sql("city"),
    "stored_session_stat": _week_stats_sql(),
    "task_results": " UNION ALL ".join(f"SELECT *, {t}::BIGINT AS task_id FROM ({_task_stat_sql(t)}) t{t}" for t in RESULT_TASK_IDS),
    "session_detail": _sessions() + _ACTION_TEXT + " WHERE session_id IN "
        f"(SELECT st.session_id FROM st JOIN ui USING (user_id) WHERE {FILTERS['session_filter']})",
    "category_action_counts": _CATEGORY_SQL,
    "page_flow_conversion": _flow_sql(),
    "product_status_clicks": _all_actions()
        + "SELECT p_partkey AS product_id, p_name AS product_name, CAST(p_size % 2 AS INT) AS product_status, count(*) AS clicks "
          f"FROM uva JOIN part ON p_partkey = click_product_id WHERE p_size % 2 = {SOLD_STATUS} GROUP BY ALL",
    "time_parse": _all_actions() + ", " + _TIME_TEXT
        + "SELECT action_time_text, CASE WHEN is_time THEN CAST(epoch(action_time) AS BIGINT) END AS epoch_seconds, "
          "CASE WHEN is_time THEN strftime(action_time, '%Y-%m-%d %H:%M:%S') END AS normalized FROM tt",
    "time_compare": _all_actions() + ", " + _TIME_TEXT
        + "SELECT action_time_text, strftime(date, '%Y-%m-%d') || ' 12:00:00.0' AS noon_text, "
          "is_time AND hour(action_time) < 12 AS is_before, "
          "is_time AND (hour(action_time) > 12 OR (hour(action_time) = 12 AND (minute(action_time) > 0 OR second(action_time) > 0))) AS is_after "
          "FROM tt",
    "time_diff_seconds": _all_actions() + ", " + _TIME_TEXT
        + "SELECT action_time_text, strftime(date, '%Y-%m-%d') || ' 0:00:00' AS midnight_text, "
          "CAST(CASE WHEN is_time THEN hour(action_time) * 3600 + minute(action_time) * 60 + second(action_time) ELSE 0 END AS INTEGER) AS seconds_into_day "
          "FROM tt",
    "actions_per_date_hour": _all_actions()
        + "SELECT strftime(action_time, '%Y-%m-%d_%H') AS date_hour, CAST(count(*) AS BIGINT) AS actions "
          "FROM uva GROUP BY 1",
    "time_format": _all_actions()
        + "SELECT session_id, strftime(action_time, '%Y-%m-%d') AS action_date, "
          "strftime(action_time, '%Y-%m-%d %H:%M:%S') AS action_time FROM uva",
    "round_half_up": "SELECT l_orderkey, l_linenumber, "
        f"{_round_sql(_REV, 2)} AS revenue_2, {_round_sql(_REV, 1)} AS revenue_1, "
        f"{_round_sql(_REV, 0)} AS revenue_0, {_round_sql('(l_extendedprice * l_tax)', 2)} AS tax_2 "
        "FROM lineitem",
    "trim_comma": _sessions()
        + "SELECT session_id, ',' || coalesce(array_to_string(list_transform(list_sort(kw_list), lambda x: x || ','), ''), '') AS keyword_buffer, "
          "search_keywords FROM st",
    "pad_two": _all_actions()
        + "SELECT session_id, "
          "CASE WHEN length(CAST(hour(action_time) AS VARCHAR)) = 2 THEN CAST(hour(action_time) AS VARCHAR) ELSE '0' || CAST(hour(action_time) AS VARCHAR) END AS hh, "
          "CASE WHEN length(CAST(minute(action_time) AS VARCHAR)) = 2 THEN CAST(minute(action_time) AS VARCHAR) ELSE '0' || CAST(minute(action_time) AS VARCHAR) END AS mi, "
          "CASE WHEN length(CAST(second(action_time) AS VARCHAR)) = 2 THEN CAST(second(action_time) AS VARCHAR) ELSE '0' || CAST(second(action_time) AS VARCHAR) END AS ss, "
          "CASE WHEN length(CAST(user_id AS VARCHAR)) = 2 THEN CAST(user_id AS VARCHAR) ELSE '0' || CAST(user_id AS VARCHAR) END AS user_text "
          "FROM uva",
    "packed_get": _sessions() + ", " + _PACKED
        + "\nSELECT pk.packed, CAST(st.visit_length AS VARCHAR) AS visit_length, "
          "CAST(st.step_length AS VARCHAR) AS step_length, st.search_keywords, "
          "CAST(NULL AS VARCHAR) AS age FROM pk JOIN st ON pk.session_id = st.session_id",
    "packed_set": _sessions() + ", " + _PACKED
        + "\nSELECT session_id, replace(packed, '|stepLength=' || CAST(step_length AS VARCHAR) || '|', "
          "'|stepLength=' || CAST(step_length + 1 AS VARCHAR) || '|') AS packed_next, packed AS packed_unknown FROM pk",
}
