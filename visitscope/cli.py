"""Command line for the session analysis job (entry 1, S7).

    spark-submit --py-files visitscope.zip -m visitscope.cli \\
        --task-id 42 --tasks-jdbc-url jdbc:mysql://db/analytics --output /shared/stats

The task id is a required argument. Task rows come from a JDBC table
(`--tasks-jdbc-url`, `--tasks-table`) or, for the generated test tables,
from the derived task view (`--sf-dir`). Actions and profiles come from
catalog tables (`--actions-table`, `--users-table`) or from `--sf-dir`.
The 16 counters are printed, and written when `--output` (Parquet folder,
one partition a task; results of other tasks stay) or `--output-jdbc-table` is
given. `--details` also writes the action rows of the passing sessions, from
the same set of sessions, kept once in `spark.checkpoint.dir`. Stored time texts
of the window that are no times are counted and reported.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .plans.job import analyze_task, session_report
from .plans.params import TaskRequest, load_task_request
from .session import configure
from .sources.jdbc import JdbcTarget, append_task_once, read_tasks
from .sources.results import write_task_result
from .sources.tables import CatalogSource, filter_date_range, session, unparsed_times
from .sources.testdata import GeneratedSource


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="visitscope", description=__doc__.split("\n\n")[0])
    p.add_argument("--task-id", type=int, required=True)
    p.add_argument("--sf-dir", help="generated test tables instead of catalog tables")
    p.add_argument("--actions-table", default="user_visit_action")
    p.add_argument("--users-table", default="user_info")
    p.add_argument("--tasks-jdbc-url")
    p.add_argument("--tasks-table", default="task")
    p.add_argument("--jdbc-user", default=os.environ.get("JDBC_USER"))
    p.add_argument("--jdbc-password", default=os.environ.get("JDBC_PASSWORD"))
    p.add_argument("--jdbc-driver")
    p.add_argument("--output", help="Parquet folder for the statistics, partitioned by task")
    p.add_argument("--details", help="Parquet folder for the passing sessions' action rows, partitioned by task")
    p.add_argument("--output-jdbc-table", help="JDBC table the statistics are appended to")
    p.add_argument("--hive", action="store_true", help="read catalog tables from the Hive metastore")
    return p


def report_unparsed(actions: DataFrame, request: TaskRequest) -> None:
    """Say on standard error how many stored time texts of the task's window are no times."""
    if dict(actions.dtypes).get("action_time") != "string":
        return
    bad = unparsed_times(filter_date_range(actions, request.start_date, request.end_date)).first()
    if bad["unparsed"]:
        print(f"{bad['unparsed']} of {bad['actions']} actions have a time text that is no time", file=sys.stderr)


def main(argv: list[str] | None = None) -> None:
    args = build_parser().parse_args(argv)
    spark = configure(session(args.hive, f"visitscope-task-{args.task_id}"))

    if args.output_jdbc_table and not args.tasks_jdbc_url:
        raise SystemExit("--output-jdbc-table needs --tasks-jdbc-url")
    target = None
    if args.tasks_jdbc_url:
        target = JdbcTarget(args.tasks_jdbc_url, args.jdbc_user, args.jdbc_password, args.jdbc_driver)

    if args.sf_dir:
        source = GeneratedSource(spark, args.sf_dir)
        tasks = read_tasks(spark, target, args.tasks_table, args.task_id) if target else source.tasks()
    else:
        if target is None:
            raise SystemExit("--tasks-jdbc-url is required unless --sf-dir is given")
        source = CatalogSource(spark, args.actions_table, args.users_table)
        tasks = read_tasks(spark, target, args.tasks_table, args.task_id)

    if args.details or isinstance(source, CatalogSource):
        request = load_task_request(tasks, args.task_id)
        if isinstance(source, CatalogSource):
            report_unparsed(spark.table(args.actions_table), request)
    if args.details:
        report = session_report(source, request.start_date, request.end_date, request.spec)
        stats = report.counters
        write_task_result(report.details, args.details, args.task_id)
    else:
        stats = analyze_task(source, tasks, args.task_id)
    # 16 rows: bounded, so the job runs once and every sink is fed from them.
    rows = stats.collect()
    for row in rows:
        print(f"{row['metric']}\t{row['cnt']}")
    result = spark.createDataFrame(rows, stats.schema).coalesce(1)
    if args.output:
        write_task_result(result, args.output, args.task_id)
    if args.output_jdbc_table and not append_task_once(
            result.withColumn("task_id", F.lit(args.task_id).cast("bigint")), target, args.output_jdbc_table, args.task_id):
        print(f"{args.output_jdbc_table} has the rows of task {args.task_id}; none were added")


if __name__ == "__main__":
    main()
