"""Page one-step conversion over a page flow (declared in the reference without code).

A flow names pages in order, `1,2,3`. A step of the flow is taken when an
action on its first page is followed, as the next action of the session, by one
on its second page. The conversion of the first step is its share of the visits
of the flow's first page, that of every other step its share of the step before.

A session is never sorted as a whole. Its rows are cut into slices of time;
within a slice the next page is found by a window, and what is left of the
slice is a state of a few numbers: the first and last page, the visits of the
flow's start, and the steps taken inside. States of neighbouring slices merge by
adding up and by one more step where the last page of one and the first page of
the next make one. So the rows of a session that holds a third of the table
spread over the tasks by slice, and only one state a slice meets in a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE_SECONDS = 600


def parse_flow(text: str) -> list[int]:
    """Pages of a task's flow text `1,2,3`; at least two."""
    pages = [int(p) for p in text.split(",")]
    if len(pages) < 2:
        raise ValueError(f"a page flow needs two pages or more: {text!r}")
    return pages


def _steps(pages: Sequence[int]) -> list[tuple[int, int]]:
    return list(zip(pages[:-1], pages[1:], strict=True))


def _taken(here: str, after: str, step: tuple[int, int]) -> Column:
    return F.expr(f"count_if({here} = {step[0]} AND {after} = {step[1]})")


def slice_states(actions: DataFrame, pages: Sequence[int], order: Sequence[str] = (), slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """(session_id, slice, first_page, last_page, starts, s0, s1, ...): one state for each slice of a session.

    Actions are in order of their time, then of the columns `order`; an action
    without a time has no place in it and is left out.
    """
    by_slice = Window.partitionBy("session_id", "slice").orderBy("action_time", *order)
    rows = actions.where("action_time IS NOT NULL").select(
        "session_id", "action_time", *order, "page_id",
        F.expr(f"floor(unix_timestamp(action_time) / {int(slice_seconds)})").alias("slice"))
    seen = rows.select("session_id", "slice", "page_id", F.lead("page_id").over(by_slice).alias("next_page"),
                       F.lag(F.lit(1)).over(by_slice).isNull().alias("is_first"), F.lead(F.lit(1)).over(by_slice).isNull().alias("is_last"))
    return seen.groupBy("session_id", "slice").agg(
        F.expr("max(CASE WHEN is_first THEN page_id END) AS first_page"), F.expr("max(CASE WHEN is_last THEN page_id END) AS last_page"),
        F.expr(f"count_if(page_id = {pages[0]}) AS starts"),
        *(_taken("page_id", "next_page", step).alias(f"s{k}") for k, step in enumerate(_steps(pages))))


def page_conversion(actions: DataFrame, pages: Sequence[int], order: Sequence[str] = (), slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """(step, page_split, visits, base, conversion_rate) of every step of the flow, in one row each.

    `visits` counts the times the step was taken, `base` what they are a share
    of; a step whose base is 0 has the rate 0. A page that stands twice in the
    flow counts in each of its steps. An empty table gives zeros.
    """
    steps = _steps(pages)
    merged = Window.partitionBy("session_id").orderBy("slice")
    states = slice_states(actions, pages, order, slice_seconds)
    between = states.withColumn("next_page", F.lead("first_page").over(merged))
    total = between.agg(F.expr("coalesce(sum(starts), 0) AS starts"),
                        *((F.expr(f"coalesce(sum(s{k}), 0)") + _taken("last_page", "next_page", step)).alias(f"v{k}")
                          for k, step in enumerate(steps)))
    rows = ", ".join(f"{k}, '{a}_{b}', v{k}, {'starts' if k == 0 else f'v{k - 1}'}" for k, (a, b) in enumerate(steps))
    return total.selectExpr(f"stack({len(steps)}, {rows}) AS (step, page_split, visits, base)").withColumn(
        "conversion_rate", F.expr("CASE WHEN base = 0 THEN 0.0D ELSE CAST(visits AS DOUBLE) / CAST(base AS DOUBLE) END"))
