"""Date and time helpers as column expressions (JVM-side, codegen'd).

Text times use `yyyy-MM-dd HH:mm:ss`; parsing reads the leading date and
time, takes parts of one or two digits and ignores what follows (a
fraction, a zone, words). Bad text never raises: comparisons give false and
differences 0. A day or time that does not exist (`2024-02-30`, `25:00:00`)
is bad text; it is not carried over into the next month or day.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import DATE_FORMAT, DATE_HOUR_FORMAT, TIME_FORMAT, TIME_PARSE_FORMAT, TIME_PREFIX

_INT_MIN, _INT_MAX = -(2 ** 31), 2 ** 31 - 1


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_time(text: Column | str) -> Column:
    """Text to timestamp; null when the text is not a time.

    A text that begins with a padded time is told by its separators and cast,
    which takes no regular expression; only other texts are searched.
    """
    c = _col(text)
    head = F.substr(c, F.lit(1), F.lit(19))
    # The year 0 does not exist; a cast would take it.
    padded = (F.translate(head, "0123456789", "##########") == "####-##-## ##:##:##") & (c >= "0001")
    # No prefix is null, not a text whose parsing fails by an exception.
    prefix = F.nullif(F.regexp_extract(c, TIME_PREFIX, 1), F.lit(""))
    return F.when(padded, head.try_cast("timestamp")).otherwise(
        F.try_to_timestamp(F.regexp_replace(prefix, " +", " "), F.lit(TIME_PARSE_FORMAT)))


def before(time1: Column | str, time2: Column | str) -> Column:
    """time1 is earlier than time2; false when either is not a time."""
    return F.coalesce(parse_time(time1) < parse_time(time2), F.lit(False))


def after(time1: Column | str, time2: Column | str) -> Column:
    """time1 is later than time2; false when either is not a time."""
    return F.coalesce(parse_time(time1) > parse_time(time2), F.lit(False))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from `start` to `end` for timestamp columns."""
    return F.unix_timestamp(_col(end)) - F.unix_timestamp(_col(start))


def minus_seconds(time1: Column | str, time2: Column | str) -> Column:
    """Signed seconds time1 - time2 as int; 0 on bad text or int overflow."""
    diff = seconds_between(parse_time(time2), parse_time(time1))
    in_range = diff.between(_INT_MIN, _INT_MAX)
    return F.when(in_range, diff.cast("int")).otherwise(F.lit(0))


def date_hour(ts: Column | str) -> Column:
    """`yyyy-MM-dd_HH` grouping key (hour always two digits) (C4)."""
    return F.date_format(_col(ts), DATE_HOUR_FORMAT)


def today_date() -> Column:
    """Today's date as `yyyy-MM-dd` in the session time zone."""
    return F.date_format(F.current_date(), DATE_FORMAT)


def yesterday_date() -> Column:
    """Yesterday's date as `yyyy-MM-dd`."""
    return F.date_format(F.date_sub(F.current_date(), 1), DATE_FORMAT)


def format_date(ts: Column | str) -> Column:
    """Date or timestamp to `yyyy-MM-dd`."""
    return F.date_format(_col(ts), DATE_FORMAT)


def format_time(ts: Column | str) -> Column:
    """Timestamp to `yyyy-MM-dd HH:mm:ss`."""
    return F.date_format(_col(ts), TIME_FORMAT)


def to_action_time(value: Column | str) -> Column:
    """Action time as a timestamp in whole seconds.

    Accepts a timestamp (with or without zone) or time text; sub-second
    parts are cut so that lengths are computed on whole seconds.
    """
    return F.date_trunc("second", _col(value))
