"""Result table of the analysis job (K3): Parquet, one partition a task.

A run replaces the partition of its own task and no other, so results of
earlier tasks stay and a repeated task leaves its rows once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TASK_ID = "task_id"


def write_task_result(result: DataFrame, path: str, task_id: int) -> None:
    """Store `result` as the rows of `task_id` under `path`, in place of what an earlier run of the task left there.

    The task is known before the write, so its partition's folder is overwritten
    as a whole; a result without rows empties it.
    """
    result.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{TASK_ID}={int(task_id)}")


def read_task_results(spark: SparkSession, path: str, schema: str = "metric string, cnt bigint") -> DataFrame:
    """All stored results: the columns of `schema` and the task id."""
    return spark.read.schema(f"{schema}, {TASK_ID} bigint").parquet(path)
