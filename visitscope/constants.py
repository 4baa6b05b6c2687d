"""Names and edges the results must carry.

FIXED VALUES — these must equal the analysed job's own names and edges
for the results to line up; they are stated here once, in natural order,
and every column, long-form row and packed string is generated from them.
"""

from __future__ import annotations

# --- fixed values: session statistic counter names, in declaration order ---
SESSION_COUNT = "session_count"

# (metric name, lowest length, highest length or None for "no upper edge")
# visit length in whole seconds
VISIT_BANDS: tuple[tuple[str, int, int | None], ...] = (
    ("1s_3s", 1, 3),
    ("4s_6s", 4, 6),
    ("7s_9s", 7, 9),
    ("10s_30s", 10, 30),
    ("30s_60s", 31, 60),
    ("1m_3m", 61, 180),
    ("3m_10m", 181, 600),
    ("10m_30m", 601, 1800),
    ("30m", 1801, None),
)

# step length in action rows
STEP_BANDS: tuple[tuple[str, int, int | None], ...] = (
    ("1_3", 1, 3),
    ("4_6", 4, 6),
    ("7_9", 7, 9),
    ("10_30", 10, 30),
    ("30_60", 31, 60),
    ("60", 61, None),
)

# --- fixed values: task parameter names inside the task JSON ---
PARAM_START_DATE = "startDate"
PARAM_END_DATE = "endDate"
PARAM_START_AGE = "startAge"
PARAM_END_AGE = "endAge"
PARAM_PROFESSIONALS = "professionals"
PARAM_CITIES = "cities"
PARAM_SEX = "sex"
PARAM_KEYWORDS = "keywords"
PARAM_CATEGORY_IDS = "categoryIds"

TASK_PARAM_FIELDS = (
    PARAM_START_DATE,
    PARAM_END_DATE,
    PARAM_START_AGE,
    PARAM_END_AGE,
    PARAM_PROFESSIONALS,
    PARAM_CITIES,
    PARAM_SEX,
    PARAM_KEYWORDS,
    PARAM_CATEGORY_IDS,
)

# --- fixed values: field names of the packed `k=v|k=v` session record ---
FIELD_SESSION_ID = "sessionid"
FIELD_SEARCH_KEYWORDS = "searchKeywords"
FIELD_CLICK_CATEGORY_IDS = "clickCategoryIds"
FIELD_VISIT_LENGTH = "visitLength"
FIELD_STEP_LENGTH = "stepLength"
FIELD_START_TIME = "startTime"
FIELD_AGE = "age"
FIELD_PROFESSIONAL = "professional"
FIELD_CITY = "city"
FIELD_SEX = "sex"

# --- fixed values: text formats of dates and times ---
DATE_FORMAT = "yyyy-MM-dd"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Parsing takes the leading part of a text; its parts may have one digit (`2018-4-9 7:5:9`).
TIME_PREFIX = r"^\s*(\d{1,4}-\d{1,2}-\d{1,2} +\d{1,2}:\d{1,2}:\d{1,2})"
TIME_PARSE_FORMAT = "y-M-d H:m:s"
DATE_HOUR_FORMAT = "yyyy-MM-dd_HH"

PACKED_FIELD_SEP = "|"
PACKED_KV_SEP = "="


def stat_metrics() -> list[str]:
    """All 16 counter names in declaration order."""
    return [SESSION_COUNT] + [b[0] for b in VISIT_BANDS] + [b[0] for b in STEP_BANDS]
