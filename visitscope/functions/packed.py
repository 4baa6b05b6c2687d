"""Column codec for packed `k=v|k=v` text.

Typed columns are the working form; packed text exists only as an
input/output format. A field is found by a regular expression without
repeated groups and packing is `concat_ws`: built-in, code-generated
expressions, with no per-row array and no lambda.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import PACKED_FIELD_SEP, PACKED_KV_SEP


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _quoted(field: str) -> str:
    """`field` as a literal inside a Java regular expression."""
    if "\\E" in field:
        raise ValueError(f"unsupported field name: {field!r}")
    return "\\Q" + field + "\\E"


def get_field(packed: Column | str, field: str) -> Column:
    """Value of the first `field=` entry, null when there is none.

    The value is everything after the first `=` up to the next `|`;
    repeated names are allowed (first wins), unlike `str_to_map`, which
    raises on them. One pass of a code-generated regular expression, no array.
    """
    entry = F.regexp_substr(_col(packed), F.lit("(?<![^|])" + _quoted(field) + "=[^|]*"))
    return F.substr(entry, F.lit(len(field) + 2))


def set_field(packed: Column | str, field: str, value: Column | str) -> Column:
    """Replace the value of the first entry named `field` (C14).

    Order is kept and an unknown field leaves the entries as they are; as
    with a plain split and join, empty entries at the end are dropped. The
    entry is found by its boundary and spliced out, so a record may have any
    number of entries.
    """
    c = _col(packed)
    new_value = F.lit(value) if isinstance(value, str) else value.cast("string")
    begin = F.regexp_instr(c, F.lit("(?<![^|])" + _quoted(field) + "(?=[=|]|\\z)"))
    bar = F.position(F.lit(PACKED_FIELD_SEP), c, begin + len(field))
    end = F.when(bar > 0, bar).otherwise(F.length(c) + 1)
    spliced = F.concat(F.substr(c, F.lit(1), begin - 1), F.lit(field + PACKED_KV_SEP), new_value, F.substr(c, end))
    return F.rtrim(F.when(begin > 0, spliced).otherwise(c), F.lit(PACKED_FIELD_SEP))


def increment(packed: Column | str, field: str, by: int = 1) -> Column:
    """Add `by` to the counter `field` (accumulator add); an unknown field leaves the record as it is.

    A value that is no number counts as 0.
    """
    count = F.coalesce(get_field(packed, field).try_cast("bigint"), F.lit(0)) + F.lit(by)
    return set_field(packed, field, count.cast("string"))


def entry_names(packed: Column | str) -> Column:
    """Names of all `name=value` entries of a record, in order, as an array."""
    return F.regexp_extract_all(_col(packed), F.lit("(?:^|[|])([^=|]*)="), F.lit(1))


def entry_values(packed: Column | str) -> Column:
    """Values of all `name=value` entries, beside `entry_names`; a value may hold `=`."""
    return F.regexp_extract_all(_col(packed), F.lit("(?:^|[|])[^=|]*=([^|]*)"), F.lit(1))


def pack(fields: Iterable[tuple[str, Column | str]]) -> Column:
    """`name=value|name=value` in the given order; null values as empty text."""
    parts = [
        F.concat(F.lit(name + PACKED_KV_SEP), F.coalesce(_col(c).cast("string"), F.lit("")))
        for name, c in fields
    ]
    return F.concat_ws(PACKED_FIELD_SEP, *parts)
