"""The session analysis job: actions -> sessions -> profiles -> filters -> statistics.

Plan of `session_stat_slots` (exchanges: by session, by user, the profile side
when it is not broadcast, and the single-row total):

1. scan actions of the date range (filter pushed into the scan);
2. roll up per session -- partial aggregate, exchange by session id, final
   aggregate; keyword / category filters are folded into it as `bool_or`;
3. count sessions per owner and band -- partial aggregate, exchange by
   user id; the profile join therefore sees one row per user, whatever
   share of sessions a single user owns;
4. join the filtered profile ids (profile predicates pushed into the
   profile scan; broadcast only if AQE measures the side small, otherwise
   sort-merge with the counts side already partitioned by user id);
5. sum the 16 counters into one row (partial sums, single-row exchange).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from ..functions.timefmt import format_time
from ..operators.detail import detail_rows
from ..operators.filters import FilterSpec, profile_predicate, session_hit_predicate
from ..operators.profile import attach_profile
from ..operators.rollup import session_core
from ..operators.stats import slot_counts, slot_sums, slots_to_long, slots_to_packed
from ..session import checkpoint_dir
from .params import TaskRequest, load_task_request


def filtered_sessions(source, start: str | dt.date | None = None, end: str | dt.date | None = None,
                      spec: FilterSpec = FilterSpec()) -> DataFrame:
    """Sessions of the range that pass every filter of `spec`, with profile.

    Without a range the whole action table is read.

    Columns: session_id, user_id, visit_length, step_length, start_time
    (text), age, professional, city, sex.
    """
    sessions = session_core(source.actions(start, end), spec).where(session_hit_predicate(spec))
    users = source.users().where(profile_predicate(spec))
    joined = attach_profile(sessions, users)
    return joined.select(
        "session_id", "user_id", "visit_length", "step_length",
        format_time("start_ts").alias("start_time"),
        "age", "professional", "city", "sex",
    )


def session_stat_slots(source, start: str | dt.date | None = None, end: str | dt.date | None = None,
                       spec: FilterSpec = FilterSpec()) -> DataFrame:
    """One row with the 16 counters of the sessions passing `spec`."""
    sessions = session_core(source.actions(start, end), spec).where(session_hit_predicate(spec))
    per_user = sessions.groupBy("user_id").agg(*slot_counts())
    user_ids = source.users().where(profile_predicate(spec)).select("user_id")
    return per_user.join(user_ids, "user_id", "inner").agg(*slot_sums())


def session_stats(source, start: str | dt.date | None = None, end: str | dt.date | None = None,
                  spec: FilterSpec = FilterSpec(), metrics: list[str] | None = None) -> DataFrame:
    """`(metric, cnt)` rows: session_count and every visit / step band."""
    return slots_to_long(session_stat_slots(source, start, end, spec), metrics)


def session_stats_packed(source, start=None, end=None, spec: FilterSpec = FilterSpec()) -> DataFrame:
    """The counters as one `k=v|k=v` text."""
    return slots_to_packed(session_stat_slots(source, start, end, spec))


def packed_user_states(source, start=None, end=None, spec: FilterSpec = FilterSpec()) -> DataFrame:
    """(user_id, city, stat): the packed counters of every user's passing sessions."""
    sessions = session_core(source.actions(start, end), spec).where(session_hit_predicate(spec))
    per_user = sessions.groupBy("user_id").agg(*slot_counts())
    users = source.users().where(profile_predicate(spec)).select("user_id", "city")
    return slots_to_packed(per_user.join(users, "user_id", "inner"), by=["user_id", "city"])


def run_request(source, request: TaskRequest) -> DataFrame:
    return session_stats(source, request.start_date, request.end_date, request.spec)


def analyze_task(source, tasks: DataFrame, task_id: int) -> DataFrame:
    """Statistics for a stored task: look it up by id, parse, run (entry 1)."""
    return run_request(source, load_task_request(tasks, task_id))


@dataclass(frozen=True)
class SessionReport:
    """Counters and detail rows of one set of passing sessions."""

    passing: DataFrame
    counters: DataFrame
    details: DataFrame


def session_report(source, start: str | dt.date | None = None, end: str | dt.date | None = None,
                   spec: FilterSpec = FilterSpec(), how: str | None = "checkpoint") -> SessionReport:
    """The passing sessions, kept once by `materialize`, and what is read from them.

    The actions are rolled up, joined and filtered once; the 16 counters are
    then counted over the kept sessions, without the action table, and the
    detail rows are the actions that a semi-join with them leaves.
    """
    passing = materialize(filtered_sessions(source, start, end, spec), how)
    counters = slots_to_long(passing.agg(*slot_counts()))
    return SessionReport(passing, counters, detail_rows(source.actions(start, end), passing.where("step_length >= 1")))


def materialize(df: DataFrame, how: str | None) -> DataFrame:
    """Keep an intermediate result for several consumers.

    `persist` keeps it in executor memory and disk; `checkpoint` writes it
    to the cluster's shared checkpoint folder (`spark.checkpoint.dir`) and
    cuts the lineage, so a lost executor does not recompute the scan.
    """
    if how is None:
        return df
    if how == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if how == "checkpoint":
        checkpoint_dir(df.sparkSession)
        # Writing the checkpoint runs the plan a second time unless its rows are kept.
        kept = df.persist(StorageLevel.MEMORY_AND_DISK)
        written = kept.checkpoint(eager=True)
        kept.unpersist()
        return written
    raise ValueError(f"unknown materialization: {how!r}")
