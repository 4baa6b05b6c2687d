"""Session roll-up: one row per session from its action rows.

Plan shape, and why it holds when one session owns a large share of rows:

* `session_core` is a single `groupBy(session_id)` of mergeable aggregates
  (min / max / count / bool_or). Spark runs a partial aggregate before the
  shuffle, so a hot session leaves each map task as one small row.
* `session_records` also builds the distinct keyword and category lists.
  Every action is expanded to one statistics row and one row for each value
  it carries, and the first level is keyed by (session, value): the values
  of a hot session spread over all reducers, and the last level receives
  K + C + 1 rows of a session with K keywords and C categories, never
  their pairs and never its action rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to_null
from ..functions.timefmt import format_time, seconds_between
from .filters import FilterSpec, session_hit_aggregates


def session_core(actions: DataFrame, spec: FilterSpec | None = None) -> DataFrame:
    """Owner, start, end, visit length and step length per session.

    Owner is the smallest user id met in the session (a repeatable choice
    where row order is not defined). Visit length is whole seconds between
    the first and last action; step length is the number of action rows.
    When `spec` asks for keywords or categories, `keyword_hit` /
    `category_hit` flags are folded in the same aggregate.
    """
    aggs = [
        F.min("user_id").alias("user_id"),
        F.min("action_time").alias("start_ts"),
        F.max("action_time").alias("end_ts"),
        F.count(F.lit(1)).alias("step_length"),
    ]
    if spec is not None:
        aggs += session_hit_aggregates(spec)
    rolled = actions.groupBy("session_id").agg(*aggs)
    return rolled.withColumn("visit_length", seconds_between("start_ts", "end_ts"))


def session_values(actions: DataFrame, keywords: bool = True, categories: bool = True) -> DataFrame:
    """One row per session and distinct value, and one without a value that carries its statistics.

    Columns: session_id, keyword and category as asked for, user_id, start_ts,
    end_ts, steps; the last four are null (0 for steps) on rows that carry a value.
    """
    kinds = {"keyword": "STRING"} if keywords else {}
    kinds |= {"category": "BIGINT"} if categories else {}
    rows = [", ".join([*(f"CAST(NULL AS {t})" for t in kinds.values()), "user_id, action_time, 1"])]
    rows += [", ".join([*(k if k == kind else "NULL" for k in kinds), "NULL, NULL, 0"]) for kind in kinds]
    names = ", ".join([*kinds, "user_id", "at", "step"])
    expanded = actions.select(
        "session_id", "user_id", "action_time",
        blank_to_null("search_keyword").alias("keyword"),
        F.col("click_category_id").alias("category"),
    ).selectExpr("session_id", f"stack({len(rows)}, {', '.join(rows)}) AS ({names})")
    return (expanded.where(" OR ".join(["step = 1", *(f"{k} IS NOT NULL" for k in kinds)]))
            .groupBy("session_id", *kinds)
            .agg(F.min("user_id").alias("user_id"), F.min("at").alias("start_ts"),
                 F.max("at").alias("end_ts"), F.sum("step").alias("steps")))


def session_records(actions: DataFrame, keywords: bool = True, categories: bool = True) -> DataFrame:
    """Full session record with typed, sorted, distinct lists.

    Columns: session_id, user_id, search_keywords array<string>,
    click_category_ids array<bigint>, visit_length, step_length,
    start_ts, end_ts. A list that is not asked for is left empty, and its
    values are never expanded.

    One scan, two aggregation levels, no join: `session_values`, then by
    session.
    """
    # collect_list (not collect_set): a duplicate-sensitive aggregate keeps the
    # optimizer from dropping the first level as redundant, which would send
    # every partial list of a hot session to one reducer.
    def distinct(asked: bool, column: str, kind: str) -> Column:
        return F.sort_array(F.collect_list(column)) if asked else F.array().cast(f"array<{kind}>")

    rolled = session_values(actions, keywords, categories).groupBy("session_id").agg(
        F.min("user_id").alias("user_id"),
        distinct(keywords, "keyword", "string").alias("search_keywords"),
        distinct(categories, "category", "bigint").alias("click_category_ids"),
        F.min("start_ts").alias("start_ts"),
        F.max("end_ts").alias("end_ts"),
        F.sum("steps").alias("step_length"),
    )
    return rolled.select(
        "session_id",
        "user_id",
        "search_keywords",
        "click_category_ids",
        seconds_between("start_ts", "end_ts").alias("visit_length"),
        "step_length",
        "start_ts",
        "end_ts",
    )


def list_text(c: Column | str) -> Column:
    """A list column as comma-joined text (empty list: empty text)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.array_join(col.cast("array<string>"), ",")


def session_records_text(actions: DataFrame) -> DataFrame:
    """Session records with lists as comma text and start time as text."""
    rec = session_records(actions)
    return rec.select(
        "session_id",
        "user_id",
        list_text("search_keywords").alias("search_keywords"),
        list_text("click_category_ids").alias("click_category_ids"),
        "visit_length",
        "step_length",
        format_time("start_ts").alias("start_time"),
    )
