"""Visit-length and step-length statistics over sessions.

The sixteen counters are ordinary conditional counts in one aggregate:
partial counts per partition, merged field by field (no accumulator, so
task retries cannot double count). One band list drives the wide row,
the long `(metric, cnt)` form and the packed text form.

The counters are written as SQL expressions: one call into the JVM per
column instead of one per operator node keeps plan construction cheap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import SESSION_COUNT, STEP_BANDS, VISIT_BANDS, stat_metrics
from ..functions.packed import entry_names, entry_values

METRICS = stat_metrics()


def _in_band(column: str, lo: int, hi: int | None) -> str:
    return f"{column} >= {lo}" if hi is None else f"{column} BETWEEN {lo} AND {hi}"


def metric_conditions(visit_length: str = "visit_length",
                      step_length: str = "step_length") -> list[tuple[str, str]]:
    """(metric, SQL condition) for all 16 counters, in declaration order.

    A 0-second session counts in `session_count` but in no visit band.
    """
    conds = [(SESSION_COUNT, "true")]
    conds += [(name, _in_band(visit_length, lo, hi)) for name, lo, hi in VISIT_BANDS]
    conds += [(name, _in_band(step_length, lo, hi)) for name, lo, hi in STEP_BANDS]
    return conds


def _slot(i: int) -> str:
    return f"m{i:02d}"


def slot_counts(visit_length: str = "visit_length", step_length: str = "step_length") -> list[Column]:
    """Per-group conditional counts, one slot column per metric."""
    return [F.expr(f"count_if({cond}) AS {_slot(i)}")
            for i, (_, cond) in enumerate(metric_conditions(visit_length, step_length))]


def slot_sums() -> list[Column]:
    """Merge slot columns of several groups; empty input gives zeros."""
    return [F.expr(f"CAST(coalesce(sum({_slot(i)}), 0) AS BIGINT) AS {_slot(i)}")
            for i in range(len(METRICS))]


def slots_to_long(slots: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """One slot row to `(metric string, cnt bigint)` rows, declaration order."""
    wanted = metrics or METRICS
    pairs = ", ".join(f"'{m}', {_slot(METRICS.index(m))}" for m in wanted)
    return slots.selectExpr(f"stack({len(wanted)}, {pairs}) as (metric, cnt)")


def slots_to_packed(slots: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Each slot row as one text column: `session_count=…|1s_3s=…|…|60=…` (A13), beside the columns `by`."""
    parts = ", ".join(f"'{m}=' || CAST({_slot(i)} AS STRING)" for i, m in enumerate(METRICS))
    return slots.select(*by, F.expr(f"concat_ws('|', {parts}) AS stat"))


def packed_to_slots(states: DataFrame, packed: str = "stat", by: Sequence[str] = ()) -> DataFrame:
    """Packed counter states as slot rows.

    A state is cut into entries once: two passes of a regular expression give
    the arrays of names and values, and a counter is the value beside the
    first entry of its name. A missing counter and one that is no number are
    0, so a null or empty text is the zero state; other entries are ignored.
    The generator keeps the optimizer from cutting again for every counter.
    """
    cut = F.inline(F.array(F.struct(entry_names(packed).alias("entry_names"), entry_values(packed).alias("entry_values"))))
    counters = [F.expr(f"coalesce(try_cast(try_element_at(entry_values, CAST(nullif(array_position(entry_names, '{m}'), 0) AS INT))"
                       f" AS BIGINT), 0) AS {_slot(i)}") for i, m in enumerate(METRICS)]
    return states.select(*by, cut).select(*by, *counters)


def merge_packed(states: DataFrame, packed: str = "stat", by: Sequence[str] = ()) -> DataFrame:
    """Packed states merged field by field, one row for each value of `by` or one in all.

    The states of a map task are summed before the shuffle, so a group that
    holds most of them sends one row a task. No state at all merges to the
    zero state, or to no group.
    """
    slots = packed_to_slots(states, packed, by)
    return slots_to_packed(slots.groupBy(*by).agg(*slot_sums()), by)


def _band_case(column: str, bands) -> Column:
    whens = " ".join(f"WHEN {_in_band(column, lo, hi)} THEN '{name}'" for name, lo, hi in bands)
    return F.expr(f"CASE {whens} END")


def visit_band(visit_length: str = "visit_length") -> Column:
    """Name of the visit band of a session, null for 0 seconds."""
    return _band_case(visit_length, VISIT_BANDS)


def step_band(step_length: str = "step_length") -> Column:
    """Name of the step band of a session."""
    return _band_case(step_length, STEP_BANDS)
