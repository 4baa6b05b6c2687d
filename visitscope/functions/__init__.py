"""Column-level helpers (dates, text, packed records) as built-in expressions."""

from .packed import get_field, pack, set_field
from .text import blank_to_null, pad_two, round_half_up, trim_comma
from .timefmt import (
    after,
    before,
    date_hour,
    format_date,
    format_time,
    minus_seconds,
    parse_time,
    seconds_between,
    to_action_time,
    today_date,
    yesterday_date,
)

__all__ = [
    "after", "before", "blank_to_null", "date_hour", "format_date", "format_time",
    "get_field", "minus_seconds", "pack", "pad_two", "parse_time",
    "round_half_up", "seconds_between", "set_field", "to_action_time", "today_date",
    "trim_comma", "yesterday_date",
]
