"""Where action and profile rows come from.

A source hands out two DataFrames: the action rows of an inclusive date
range and the user profiles. Every source applies the date range as a
filter on a *stored* column so that it reaches the scan: partition
pruning for a table partitioned by `date`, Parquet row-group skipping
otherwise.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import blank_to_null
from ..functions.timefmt import parse_time, to_action_time
from ..schemas import USER_INFO

USER_COLUMNS = [f.name for f in USER_INFO.fields]
PROFILE_COLUMNS = ["user_id", "age", "professional", "city", "sex"]


def as_date(value: str | dt.date) -> dt.date:
    """`yyyy-MM-dd` text or a date; anything else is a clear error."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    try:
        return dt.date.fromisoformat(str(value).strip())
    except ValueError as exc:
        raise ValueError(f"not a yyyy-MM-dd date: {value!r}") from exc


def normalize_actions(df: DataFrame) -> DataFrame:
    """Give action rows the typed schema whatever form they came in.

    Text dates and times (one-digit hours allowed) are parsed, times are
    cut to whole seconds and empty keyword text becomes null.
    """
    types = dict(df.dtypes)
    date_col = F.col("date")
    if types.get("date") == "string":
        date_col = F.try_to_date(F.col("date"), "yyyy-MM-dd")
    time_col = F.col("action_time")
    if types.get("action_time") == "string":
        time_col = parse_time("action_time")
    return df.select(
        date_col.alias("date"),
        F.col("user_id").cast("bigint").alias("user_id"),
        "session_id",
        F.col("page_id").cast("bigint").alias("page_id"),
        to_action_time(time_col).alias("action_time"),
        blank_to_null("search_keyword").alias("search_keyword"),
        F.col("click_category_id").cast("bigint").alias("click_category_id"),
        F.col("click_product_id").cast("bigint").alias("click_product_id"),
        "order_category_ids",
        "order_product_ids",
        "pay_category_ids",
        "pay_product_ids",
        F.col("city_id").cast("bigint").alias("city_id"),
    )


def date_range(start: str | dt.date | None, end: str | dt.date | None) -> tuple[dt.date, dt.date] | None:
    """The checked range, or None for "every day" when both ends are missing.

    Every source asks here, so a missing end or a start after the end is the
    same error everywhere.
    """
    if start is None and end is None:
        return None
    if start is None or end is None:
        raise ValueError("both start and end date are required")
    lo, hi = as_date(start), as_date(end)
    if lo > hi:
        raise ValueError(f"start date {lo} is after end date {hi}")
    return lo, hi


def filter_date_range(actions: DataFrame, start: str | dt.date | None, end: str | dt.date | None) -> DataFrame:
    """Action rows whose stored `date` lies in [start, end], both ends included.

    Text dates are compared as text, which orders `yyyy-MM-dd` rightly and
    reaches the scan as typed dates do. Dates are not read leniently as times
    are: a text such as `2024-1-5` is in no range.
    """
    found = date_range(start, end)
    if found is None:
        return actions
    lo, hi = found
    if dict(actions.dtypes).get("date") == "string":
        return actions.where(F.col("date").between(F.lit(lo.isoformat()), F.lit(hi.isoformat())))
    return actions.where(F.col("date").between(F.lit(lo), F.lit(hi)))


def unparsed_times(actions: DataFrame) -> DataFrame:
    """One row, (actions, unparsed): stored time texts that are not times (see `parse_time`).

    Such a row counts as a step of its session but has no part in its start,
    end and length.
    """
    time = parse_time("action_time") if dict(actions.dtypes).get("action_time") == "string" else F.col("action_time")
    return actions.agg(F.count(F.lit(1)).alias("actions"),
                       F.count_if(F.col("action_time").isNotNull() & time.isNull()).alias("unparsed"))


@dataclass
class CatalogSource:
    """Tables registered in the session catalog (Hive metastore on a cluster).

    The action table is expected to be stored partitioned by `date`, so the
    range filter prunes whole directories before any file is opened.
    """

    spark: SparkSession
    actions_table: str = "user_visit_action"
    users_table: str = "user_info"

    def actions(self, start: str | dt.date | None = None, end: str | dt.date | None = None) -> DataFrame:
        return normalize_actions(filter_date_range(self.spark.table(self.actions_table), start, end))

    def users(self) -> DataFrame:
        return self.spark.table(self.users_table).select(*USER_COLUMNS)


@dataclass
class FrameSource:
    """In-memory or already-loaded DataFrames (fixtures, S4)."""

    action_rows: DataFrame
    user_rows: DataFrame

    def actions(self, start: str | dt.date | None = None, end: str | dt.date | None = None) -> DataFrame:
        return normalize_actions(filter_date_range(self.action_rows, start, end))

    def users(self) -> DataFrame:
        return self.user_rows.select(*USER_COLUMNS)


def register_views(spark: SparkSession, actions: DataFrame, users: DataFrame,
                   products: DataFrame | None = None) -> None:
    """Register DataFrames under the names the catalog source reads."""
    actions.createOrReplaceTempView("user_visit_action")
    users.createOrReplaceTempView("user_info")
    if products is not None:
        products.createOrReplaceTempView("product_info")


def session(hive: bool = False, app_name: str | None = None) -> SparkSession:
    """Catalog choice (S3): the Hive metastore on a cluster, the session catalog otherwise."""
    builder = SparkSession.builder
    if app_name:
        builder = builder.appName(app_name)
    if hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()
