"""Schemas of the tables the session analysis reads (all columns nullable)."""

from __future__ import annotations

from pyspark.sql import types as T

# One row per user action. `action_time` is a timestamp in whole seconds;
# `date` is the action's day. Text forms of both are accepted on input
# (see sources.tables.normalize_actions).
USER_VISIT_ACTION = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("page_id", T.LongType()),
    T.StructField("action_time", T.TimestampType()),
    T.StructField("search_keyword", T.StringType()),
    T.StructField("click_category_id", T.LongType()),
    T.StructField("click_product_id", T.LongType()),
    T.StructField("order_category_ids", T.StringType()),
    T.StructField("order_product_ids", T.StringType()),
    T.StructField("pay_category_ids", T.StringType()),
    T.StructField("pay_product_ids", T.StringType()),
    T.StructField("city_id", T.LongType()),
])

# The same table as it arrives from text sources: date and time as strings.
USER_VISIT_ACTION_TEXT = T.StructType([
    T.StructField(f.name, T.StringType() if f.name in ("date", "action_time") else f.dataType)
    for f in USER_VISIT_ACTION.fields
])

USER_INFO = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("username", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("professional", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("sex", T.StringType()),
])

PRODUCT_INFO = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("extend_info", T.StringType()),
])

TASK = T.StructType([
    T.StructField("task_id", T.LongType()),
    T.StructField("task_name", T.StringType()),
    T.StructField("create_time", T.StringType()),
    T.StructField("start_time", T.StringType()),
    T.StructField("finish_time", T.StringType()),
    T.StructField("task_type", T.StringType()),
    T.StructField("task_status", T.StringType()),
    T.StructField("task_param", T.StringType()),
])

# Every task parameter is a JSON array of strings; element 0 is the value.
TASK_PARAM_DDL = (
    "startDate array<string>, endDate array<string>, "
    "startAge array<string>, endAge array<string>, "
    "professionals array<string>, cities array<string>, sex array<string>, "
    "keywords array<string>, categoryIds array<string>"
)
