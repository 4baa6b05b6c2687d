"""Analysis task parameters (P5, C16, S5 lookup).

`task_param` is JSON whose fields are arrays of text; element 0 of each
array is the value and empty text counts as absent. Parsing is Spark's
`from_json`, so a whole task table is parsed on the executors; only the
one task a job runs is brought to the driver, by key.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import TASK_PARAM_FIELDS
from ..operators.filters import FilterSpec
from ..schemas import TASK_PARAM_DDL
from ..sources.tables import as_date

# task JSON field -> output column
PARAM_COLUMNS = {
    "startDate": "start_date",
    "endDate": "end_date",
    "startAge": "start_age",
    "endAge": "end_age",
    "professionals": "professionals",
    "cities": "cities",
    "sex": "sex",
    "keywords": "keywords",
    "categoryIds": "category_ids",
}
assert tuple(PARAM_COLUMNS) == TASK_PARAM_FIELDS


def parse_task_params(tasks: DataFrame) -> DataFrame:
    """One row per task: task_id, task_name and each parameter as text or null.

    The JSON is parsed once per row: the parsed struct is unpacked by an
    `inline` generator, which keeps the optimizer from splitting the parse
    into one single-field `from_json` per parameter.
    """
    parsed = F.from_json(F.col("task_param"), TASK_PARAM_DDL)
    unpacked = tasks.select("task_id", "task_name", F.inline(F.array(parsed)))
    return unpacked.selectExpr("task_id", "task_name", *(f"nullif(get({field}, 0), '') AS {col}" for field, col in PARAM_COLUMNS.items()))


@dataclass(frozen=True)
class TaskRequest:
    """What one task asks for: an inclusive date range and session filters."""

    task_id: int | None
    start_date: dt.date
    end_date: dt.date
    spec: FilterSpec

    @classmethod
    def from_params(cls, params: dict, task_id: int | None = None) -> "TaskRequest":
        """From a parsed parameter row (column names of `parse_task_params`)."""
        start, end = params.get("start_date"), params.get("end_date")
        label = f"task {task_id}" if task_id is not None else "task"
        if not start:
            raise ValueError(f"{label} has no startDate")
        if not end:
            raise ValueError(f"{label} has no endDate")
        return cls(
            task_id=task_id,
            start_date=as_date(start),
            end_date=as_date(end),
            spec=FilterSpec.of(
                start_age=params.get("start_age"),
                end_age=params.get("end_age"),
                professionals=params.get("professionals"),
                cities=params.get("cities"),
                sex=params.get("sex"),
                keywords=params.get("keywords"),
                category_ids=params.get("category_ids"),
            ),
        )


def find_task(tasks: DataFrame, task_id: int) -> DataFrame:
    """The task row with this id (S5); the equality reaches the source's scan."""
    if task_id is None:
        raise ValueError("a task id is required")
    return tasks.where(F.col("task_id") == F.lit(int(task_id)))


def load_task_request(tasks: DataFrame, task_id: int) -> TaskRequest:
    """Look up one task by key and read its parameters on the driver.

    At most two rows are fetched: enough to tell "missing" and "duplicated"
    apart from the one expected row.
    """
    rows = parse_task_params(find_task(tasks, task_id)).limit(2).collect()
    if not rows:
        raise LookupError(f"no task with id {task_id}")
    if len(rows) > 1:
        raise LookupError(f"task id {task_id} is not unique")
    return TaskRequest.from_params(rows[0].asDict(), task_id=int(task_id))
