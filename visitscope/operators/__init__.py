"""Relational operators of the session analysis: roll-up, profile join, filters, statistics."""

from .filters import FilterSpec, profile_predicate, session_hit_predicate, session_list_predicate
from .profile import attach_profile, match_report, profiles
from .rollup import session_core, session_records, session_records_text
from .sample import sample_row
from .stats import metric_conditions, slots_to_long, slots_to_packed

__all__ = [
    "FilterSpec", "attach_profile", "match_report", "metric_conditions", "profile_predicate",
    "profiles", "sample_row", "session_core", "session_hit_predicate", "session_list_predicate",
    "session_records", "session_records_text", "slots_to_long",
    "slots_to_packed",
]
