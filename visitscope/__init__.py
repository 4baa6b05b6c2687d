"""visitscope: user-session analytics as Spark DataFrame plans.

Action rows of a date range are rolled up to one row per session, joined
to the owner's profile, filtered by a stored analysis task and counted in
visit-length and step-length bands. Every step is a built-in DataFrame
operation, so Catalyst plans it and Spark distributes it.
"""

from .operators.filters import FilterSpec
from .plans.job import analyze_task, filtered_sessions, session_stats, session_stats_packed
from .plans.params import TaskRequest, load_task_request, parse_task_params
from .sources import CatalogSource, FrameSource, GeneratedSource

__all__ = [
    "CatalogSource", "FilterSpec", "FrameSource", "GeneratedSource", "TaskRequest",
    "analyze_task", "filtered_sessions", "load_task_request", "parse_task_params",
    "session_stats", "session_stats_packed",
]
